"""Row-local building blocks: pure ``Column`` functions, usable in batch and streaming."""
