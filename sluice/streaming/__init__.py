"""Streaming forms: directory sync (T1) and lost-heartbeat detection."""
