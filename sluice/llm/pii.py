"""Personal data: fixed rules, and candidates that boosted trees accept.

The base rules find emails, IP addresses, card numbers and phone numbers; their spans always stand. Generators
of high recall propose more, overlapping spans (any token with an at sign or a written-out one, any run of
digits and separators, any dotted or spaced numbers). For each kind, trees judge a candidate by its format and
its surroundings.

Labels. A candidate that touches a base span of its kind is an example for it, the corpus's other candidates are
examples against it. Base spans are also rewritten where they stand: in forms that the base rules miss (addresses
written out, phones without a plus, spaced octets, other separators), which are examples for, and into look-alikes
(no domain, octets above 255, versions and times, a broken checksum, dates and plain numbers), which are examples
against. The plus sign is kept from the trees, so that phones without one are judged by the rest.

Thresholds. The examples of every second document are held out. Of those, the ones that the base rules do not settle
(all but the spans that touch a base one) calibrate a threshold for each kind, the least above 0.5 at which
``PRECISION`` of the accepted ones are examples for; their scores count to ``PLACES`` places. A kind that lacks examples
of either label in either half (``LEAST_EXAMPLES``) accepts nothing. An accepted candidate that touches no base span is
added.

Bounds. Trees and thresholds come from all examples of all documents: these are staged, the trees grow from sums over
their blocks (``boosting.fit_frame``), thresholds from counts for each score. The driver holds sums of fixed size. The
model is broadcast; every text is searched whole, in place. A written-out address has a local part of at most 64
characters and at most 9 labels of at most 63.

Defined results: null and empty texts have no spans. A kind without enough examples gets none added. Of overlapping
accepted candidates the one of the highest score stays (ties: the first, then the order of the kinds). Repeated rows
are searched each; other columns are not read. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import boosting
from sluice.llm.tables import staged, table
from sluice.session import staging_scope

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
PLACES = 4
LEAST_EXAMPLES = 20

#: Fixed words: what may stand before personal data, and what before other numbers.
CUES = {"email": ("mail", "email", "e-mail", "contact", "write", "address"),
        "ip": ("ip", "server", "host", "address", "from", "at"),
        "card": ("card", "visa", "mastercard", "pay", "account"),
        "phone": ("tel", "phone", "call", "mobile", "fax", "cell", "dial", "number")}
OTHER_CUES = ("version", "v", "release", "build", "section", "chapter", "room", "page", "figure", "item", "order", "no",
              "id", "isbn", "date", "since", "year", "sold")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits does, so the lookbehind changes no match
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# every base rule and generator needs one of these
_TRIGGER = re.compile(r"[0-9@\[({]")
_WIDE = (("email", re.compile(r"[^\s@<>,;:\"']+@[^\s@<>,;:\"']+")),
         ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,63}"
                              r"(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,8}", re.IGNORECASE)),
         ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:[.,:-][0-9]{1,4}){3}(?![0-9])")),
         ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?: ?\. ?[0-9]{1,4}){3}(?![0-9])")),
         ("card", re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){11,18}(?![0-9])")),
         ("phone", re.compile(r"(?<![0-9A-Za-z])[(+]{0,2}[0-9](?:[ ().\/-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])")))


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches: from each at sign the run of local characters before it."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            low = found.end()
        at = text.find("@", max(low, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            out.append(("ip", *found.span()))
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *found.span()))
    for found in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in found[0]) <= 15:
            out.append(("phone", *found.span()))
    return _ordered(out)


def _ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def candidates(text: str) -> list[tuple[str, int, int]]:
    return [(kind, *found.span()) for kind, pattern in _WIDE for found in pattern.finditer(text)]


_WORD = re.compile(r"[A-Za-z-]+")
_MARKED = re.compile(r"[\[({] ?(?:at|dot) ?[\])}]", re.IGNORECASE)
_AT = re.compile(r"@| ?[\[({] ?at ?[\])}] ?", re.IGNORECASE)
_DOT = re.compile(r" ?[\[({] ?dot ?[\])}] ?|\.", re.IGNORECASE)


def features(text: str, start: int, end: int, kind: str = "") -> list[float]:
    """Format of the span without its plus sign, and what surrounds it."""
    span = text[start:end].replace("+", "")
    digits = [c for c in span if "0" <= c <= "9"]
    parts = [g for g in re.split(r"[^0-9]+", span) if g]
    groups, values = [len(g) for g in parts], [min(int(g[:9]), 10 ** 6) for g in parts]
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    near = before[-12:]
    sides = _AT.split(span, maxsplit=1)
    labels = [x for x in _DOT.split(sides[1])] if len(sides) == 2 else []
    words = [w.lower().rstrip("-") for w in _WORD.findall(before)][-3:]
    return [len(span), len(digits), len(digits) / max(1, len(span)), sum(c.isalpha() for c in span),
            span.count("."), span.count("-"), span.count(" "), span.count("(") + span.count("["), span.count("@"),
            span.count(":"), span.count(","), span.count("/"), span.count("_"),
            len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0,
            groups[-1] if groups else 0, max(values, default=0), sum(v > 255 for v in values),
            float(bool(values) and 1800 <= values[0] <= 2100), float(luhn("".join(digits))) if len(digits) > 1 else 0.0,
            float(span[:1] == "0"), len(set(digits)), float(len(_MARKED.findall(span))),
            float(len(labels)), float(len(labels[-1])) if labels else 0.0,
            float(bool(labels) and labels[-1].isalpha() and labels[-1].isascii()),
            float(len(sides) == 2 and any(c.isalpha() for c in sides[0])),
            float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after),
            sum("0" <= c <= "9" for c in near), sum("0" <= c <= "9" for c in after),
            float(before[-2:-1] in ".:,;"), float(after[:1] in ".,;:!?)"), float("=" in near), float("/" in near),
            float(any(w in CUES.get(kind, ()) for w in words)), float(any(w in OTHER_CUES for w in words[-1:]))]


def _touching(spans: list[tuple[str, int, int]], start: int, end: int) -> bool:
    return any(a < end and start < b for _, a, b in spans)


def rewritten(kind: str, span: str, seed: int) -> list[tuple[bool, str, str]]:
    """(is still personal data, what stands before it, the rewritten text) for a base span; ``seed`` varies them."""
    rng = random.Random(seed)
    one, number = rng.choice, rng.randint
    digits = re.sub("[^0-9]", "", span)

    def plain(least: int, most: int) -> str:
        return str(number(10 ** (n := number(least, most) - 1), 10 ** (n + 1) - 1))

    if kind == "email":
        local, _, domain = span.rpartition("@")
        host, _, end = domain.partition(".")
        letters = re.sub("[^a-z]", "", local.lower()) or "git"
        out = []
        for _ in range(3):
            at, dot = one((" [at] ", "(at)", " (at) ", "[at]", " {at} ", "[ at ]")), one((".", ".", " [dot] ", "(dot)", " (dot) "))
            name = one((local, letters, f"{letters}.{host}", f"{local}.{number(1, 99)}", f"{letters[:3]}_{host}{number(1, 999)}"))
            site = one((domain, f"mail.{domain}", f"{host[:4]}.{end}", f"{host}-{letters}.{end}",
                        f"{letters}.{one(('com', 'org', 'net', 'de', 'info'))}"))
            out += [(True, "", name + at + dot.join(site.split("."))), (True, "", f"{name}@{site}"),
                    (False, one(("", "sold ", "only ")), f"{number(1, 99)}@{number(1, 999)}"),
                    (False, "", f"{name}@{site.split('.')[0]}"), (False, "", f"{letters[:number(2, 9)]}@{host[:number(2, 9)]}"),
                    (False, "", f"{name}@{number(1, 99)}.{number(0, 9)}")]
        return out
    if kind == "ip":
        parts, small = [int(x[:9]) for x in span.split(".")], [str(number(0, 30)) for _ in range(4)]
        if number(0, 2) == 0:
            parts = [number(0, 255) for _ in range(4)]
        return [(True, "", one((" . ", ". ", " .")).join(map(str, parts))), (True, "", ".".join(map(str, parts))),
                (False, one(("version ", "", "release ")), ".".join([*small[:3], plain(4, 4)])),
                (False, "", ".".join(plain(3, 3) for _ in range(3)) + f".{number(256, 999)}"),
                (False, one(("", "build ")), ".".join([*map(str, parts[:3]), str(number(256, 999))])),
                (False, one(("", "build ")), ".".join([str(parts[0]), str(number(256, 999)), *map(str, parts[2:])])),
                (False, one(("section ", "chapter ", "", "room ")), one("-:,").join(small)),
                (False, one(("room ", "", "at ")), one(":-,").join(map(str, parts)))]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + number(1, 9)) % 10)

        def cut(d: str, by: str) -> str:
            return by.join(d[i:i + 4] for i in range(0, len(d), 4))

        return [(True, "", cut(digits, one("._/"))), (True, "", cut(digits, one(" -"))), (True, "", digits),
                (False, "", cut(wrong, one("._/ -"))), (False, one(("order ", "", "id ")), wrong),
                (False, one(("order ", "", "id ")), plain(12, 19))]
    local = digits[-10:] if len(digits) > 10 and number(0, 3) else plain(10, 10)
    by, country = one(" -."), one(("", "", digits[:2] + one(" -.")))
    year, month, day = number(1950, 2049), number(1, 12), number(1, 28)
    return [(True, one(("", "call ", "tel ")), country + one((f"({local[:3]}) {local[3:6]}-{local[6:]}",
                                                              by.join([local[:3], local[3:6], local[6:]])))),
            (True, one(("", "call ", "tel ")), by.join([digits[:2], digits[2:5], digits[5:8], digits[8:]]).rstrip(by)),
            (True, "", span.lstrip("+")),
            (False, one(("", "since ", "date ", "on ")), one((f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}",
                                                              f"{day:02}/{month:02}/{year}"))),
            (False, one(("", "id ", "no ")), plain(7, 15)), (False, "", f"{year}-{year + number(0, 30)}"),
            (False, "", f"{number(0, 9)}.{plain(6, 14)}"),
            (False, one(("", "page ")), " ".join(str(number(1, 99)) for _ in range(number(4, 6))))]


class Example(NamedTuple):
    kind: str
    label: bool
    settled: bool       # a span that touches a base one
    features: list[float]


def examples(text: str) -> list[Example]:
    """The candidates of a text, and those that its base spans are rewritten into."""
    base = base_spans(text)
    out = [Example(kind, touch, touch, features(text, start, end, kind)) for kind, start, end in candidates(text)
           for touch in [_touching([s for s in base if s[0] == kind], start, end)]
           if touch or not _touching(base, start, end)]
    for kind, start, end in base:
        seed = zlib.crc32(text[max(0, start - 20):end].encode("utf-8", "replace"))
        for label, before, span in rewritten(kind, text[start:end], seed):
            changed = text[max(0, start - 60):start] + before + span + text[end:end + 60]
            at = min(start, 60) + len(before)
            for other, first, last in candidates(changed):
                if first < at + len(span) and at < last:  # a form of one kind is none of another
                    out.append(Example(other, label and other == kind, False, features(changed, first, last, other)))
    return out


def threshold(score: np.ndarray, label: np.ndarray, precision: float = PRECISION, n: np.ndarray | None = None) -> float | None:
    """What accepts the most of the scores above 0.5 such that ``precision`` of the accepted have label 1: the middle
    between the least accepted score and the next one below it (0.5 at least). With ``n``, a row stands for so many
    examples and ``label`` counts those of label 1."""
    order = np.argsort(-score, kind="stable")
    n = np.ones(len(score), dtype=np.int64) if n is None else n
    score, label, n = score[order], label[order], n[order]
    last = np.append(score[1:] != score[:-1], True)  # equal scores are accepted together
    fine = np.flatnonzero((np.cumsum(label) >= precision * np.cumsum(n)) & last & (score > 0.5))
    if not len(fine):
        return None
    return (float(score[fine[-1]]) + max(0.5, float(score[fine[-1] + 1]) if fine[-1] + 1 < len(score) else 0.5)) / 2


def fit(rows: list[tuple[bool, Example]]) -> dict[str, Any]:
    """For each kind with enough examples its trees and threshold; the rows say which half they are of. What ``learn``
    finds, for examples at hand."""
    out = {}
    for kind in KINDS:
        own = [(half, e) for half, e in rows if e.kind == kind]
        x, y = np.array([e.features for _, e in own]), np.array([e.label for _, e in own], dtype=np.float64)
        learn = np.array([half for half, _ in own], dtype=bool)
        held = ~learn & np.array([not e.settled for _, e in own], dtype=bool)
        if min((int((y[part] == label).sum()) for part in (learn, held) for label in (0, 1)), default=0) < LEAST_EXAMPLES:
            continue
        forest = boosting.fit_block(x[learn], y[learn])
        least = threshold(np.round(boosting.predict(forest, x[held]), PLACES), y[held])
        if least is not None:
            out[kind] = (forest, least)
    return out


def all_spans(text: str, model: dict[str, Any]) -> tuple[list, list]:
    """Base spans, and base and added spans together."""
    base = base_spans(text)
    found = [c for c in candidates(text) if c[0] in model and not _touching(base, c[1], c[2])]
    added: list[tuple[str, int, int]] = []
    for kind, (forest, least) in model.items() if found else ():
        if own := [c for c in found if c[0] == kind]:
            score = boosting.predict(forest, np.array([features(text, a, b, kind) for _, a, b in own]))
            added += [(s, c) for s, c in zip(score, own, strict=True) if s >= least]
    chosen: list[tuple[str, int, int]] = []
    for _, span in sorted(added, key=lambda x: (-x[0], x[1][1], KINDS.index(x[1][0]))):
        if not _touching(chosen, span[1], span[2]):
            chosen.append(span)
    return base, _ordered(base + chosen)


def example_rows(documents: DataFrame) -> DataFrame:
    """half (learned from, or held out), kind, label, settled and features of the examples of all documents."""
    def run(batches):
        for batch in batches:
            rows = [(half, e) for text, half in zip(batch.column("text"), batch.column("half").to_pylist(), strict=True)
                    if _TRIGGER.search(text.as_py() or "") for e in examples(text.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([half for half, _ in rows], pa.bool_()), pa.array([e.kind for _, e in rows], pa.string()),
                 pa.array([e.label for _, e in rows], pa.bool_()), pa.array([e.settled for _, e in rows], pa.bool_()),
                 pa.array([e.features for _, e in rows], pa.list_(pa.float64()))],
                names=["half", "kind", "label", "settled", "features"])

    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)) == 0
    return documents.select("text", half.alias("half")).mapInArrow(
        run, "half boolean, kind string, label boolean, settled boolean, features array<double>")


def training_rows(documents: DataFrame, sample: int | None = None, per_group: int | None = None) -> list[tuple[bool, Example]]:
    """``example_rows`` at hand, for tables that fit the driver; ``learn`` does without. For trials, those of the first
    ``sample`` documents by hash that hold a digit or an at sign, and ``per_group`` for each kind, label and origin."""
    if sample is not None:
        documents = documents.where(F.col("text").rlike("[0-9@]")).orderBy(
            F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    rows = example_rows(documents)
    if per_group is not None:
        least = Window.partitionBy("kind", "label", "settled").orderBy(F.xxhash64("features"), "half")
        rows = rows.withColumn("at", F.row_number().over(least)).where(F.col("at") <= per_group).drop("at")
    return [(r["half"], Example(r["kind"], r["label"], r["settled"], list(r["features"]))) for r in
            sorted(rows.collect(), key=lambda r: (r["kind"], r["half"], r["label"], r["settled"], r["features"]))]


def learn(documents: DataFrame) -> dict[str, Any]:
    """For each kind with enough examples its trees and threshold, from all examples of all documents."""
    spark = documents.sparkSession
    with staging_scope(spark):
        rows = staged(example_rows(documents), "pii-examples")
        held = ~F.col("half") & ~F.col("settled")
        counts = rows.groupBy("kind").agg(*(F.count_if(part & (F.col("label") == label)).alias(f"n{i}{int(label)}")
                                            for i, part in enumerate((F.col("half"), held)) for label in (False, True)))
        kinds = [r["kind"] for r in counts.collect() if min(r["n00"], r["n01"], r["n10"], r["n11"]) >= LEAST_EXAMPLES]
        if not kinds:
            return {}
        rows = rows.where(F.col("kind").isin(kinds))
        forests = boosting.fit_frame(rows.where("half").select(F.col("kind").alias("group"), "label", "features"))
        shared = spark.sparkContext.broadcast(forests)

        def score(batches):
            for batch in batches:
                kind = np.array(batch.column("kind").to_pylist(), dtype=object)
                x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(kind), -1) if len(kind) else None
                out = np.zeros(len(kind))
                for name in set(kind):
                    out[kind == name] = np.round(boosting.predict(shared.value[name], x[kind == name]), PLACES)
                yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("label"), pa.array(out)],
                                                 names=["kind", "label", "score"])

        scores = (rows.where(held).select("kind", "label", "features").mapInArrow(score, "kind string, label boolean, score double")
                  .where("score > 0.5").groupBy("kind", "score")
                  .agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("positive")).collect())  # at most 5,000 a kind
    out = {}
    for kind in (k for k in KINDS if k in forests):
        own = [r for r in scores if r["kind"] == kind]
        least = threshold(*(np.array([r[c] for r in own]) for c in ("score", "positive")), n=np.array([r["n"] for r in own]))
        if least is not None:
            out[kind] = (forests[kind], least)
    return out


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each stretch of spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(out) + text[at:]


def find(documents: DataFrame, model: dict[str, Any], with_text: bool = False) -> DataFrame:
    """doc_id, the counts of base spans, base_sha256, spans, n_added, and on request the redacted text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base, spans = all_spans(text, shared.value) if _TRIGGER.search(text) else ([], [])
                kinds = [kind for kind, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(),
                             _joined(spans), len(spans) - len(base), *([redact(text, spans)] if with_text else [])))
            types = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.int64(), pa.string())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (8 if with_text else 7)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added",
                       *(["redacted"] if with_text else [])])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string, n_added long" + ", redacted string" * with_text)


def op6_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return find(documents, learn(documents))
