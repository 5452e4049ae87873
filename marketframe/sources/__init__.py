"""Sources: feed normalizers, storage (scan/sink) and bindings of test tables."""
