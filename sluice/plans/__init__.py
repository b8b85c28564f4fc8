"""Report plans over the load ledger and the ledger-shaped fixture views."""
