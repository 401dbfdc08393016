"""Very long texts in parts: the same ids, in little memory."""

from __future__ import annotations

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa

from rowsmith.llm import packing, tokens
from rowsmith.llm.words import blocks


def test_parts_do_not_change_ids(monkeypatch):
    rng = random.Random(4)
    letters = [*"ab 'é日<1.\n\t ", "the", " ", " "]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 400))) for _ in range(80)] + ["x" * 300]
    whole = tokens.Tokens(packing.vocabulary())
    want = [whole.library.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(tokens, "_LONG", 40)
    for _, data, offsets in blocks(pa.array(texts), 1):
        ids, _ = whole.encode(data, offsets)
        assert ids.tolist() == want.pop(0)
    assert not want


def test_memory_of_a_long_text():
    """A text of 35 MB takes a process less than 500 MB."""
    code = """
import resource, numpy as np
from rowsmith.llm import packing, tokens
tool = tokens.tokens(packing.vocabulary())
words = np.random.default_rng(1).integers(97, 123, 1_000_000).astype(np.uint8)
words[::6] = 32
words = np.tile(words, 35)
tool.encode(words[:6000], np.array([0, 6000]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids, _ = tool.encode(words, np.array([0, len(words)]))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024, len(ids))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=600)
    grown, n = map(int, out.stdout.split())
    assert n > 5_000_000 and grown < 500, grown


def test_equal_rows_without_an_id_spread_over_cells(spark):
    """Slots are gapless, and no cell of the numbering holds more than its share."""
    from rowsmith.llm import sharding
    from tests.llm.cases import documents

    found = sharding.shard(documents(spark, [(None, "")] * 2000 + [(1, "a b")], clash=False), shards=2)
    rows = found.collect()
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
