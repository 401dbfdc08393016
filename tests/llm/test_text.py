"""Operators over whole texts, held against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from rowsmith.llm import binary_output, decontamination, packing, pii, queries, secret_scan, simhash, substrings
from rowsmith.llm.words import ALNUM, LOWER, NOT_SPACE, blocks, run_hashes, spans, word_hashes
from tests.llm.cases import PLAIN, SPACED, documents, groups, low, prose, texts

BASE36 = string.ascii_lowercase + string.digits


def words_of(text, members, lower=False):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    data = LOWER[data] if lower else data
    starts, ends = spans(data, np.array([0, len(data)]), members)
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends)], data, starts, ends


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_are_the_patterns(text):
    assert words_of(text, NOT_SPACE)[0] == SPACED.findall(text)
    assert words_of(text, ALNUM, True)[0] == PLAIN.findall(low(text))


def test_hashes_depend_on_the_words_alone():
    rng = random.Random(1)
    some = [prose(rng, 1) for _ in range(3000)]
    _, data, starts, ends = words_of(" ".join(some), NOT_SPACE)
    found = word_hashes(data, starts, ends).tolist()
    assert len({(w, h) for w, h in zip(some, found)}) == len(set(some)) == len(set(found))
    runs = run_hashes(word_hashes(data, starts, ends), 3).tolist()
    same = {}
    for i, h in enumerate(runs):
        assert same.setdefault(h, tuple(some[i : i + 3])) == tuple(some[i : i + 3])


def test_texts_are_cut_into_whole_blocks():
    column = pa.chunked_array([["ab", None, "c" * 50], ["", "é"]])
    cut = [(f, bytes(d), o.tolist()) for f, d, o in blocks(column, 10)]
    assert [b"".join(d for _, d, _ in cut)] == [b"ab" + b"c" * 50 + "é".encode()]
    assert [f for f, _, _ in cut] == [0, 2, 3]


def test_simhash(spark):
    rows = {}
    for r in simhash.near_duplicates(documents(spark)).collect():
        rows.setdefault(r.doc_id, []).append((r.fp & (2**64 - 1), r.component_id))

    def plain(text):
        w = SPACED.findall(low(text or ""))
        shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) > 3 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    every = texts()
    prints = [plain(t) for _, t in every]
    assert sorted(p for v in rows.values() for p, _ in v) == sorted(prints)
    n = range(len(every))
    links = [(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= 4]
    root = groups(links, n)
    for i, (doc, _) in enumerate(every):
        ids = [every[j][0] for j in n if root[j] == root[i] and every[j][0] is not None]
        assert (prints[i], min(ids, default=None)) in rows[doc]


@pytest.mark.parametrize("n, radius", [(1, 0), (63, 3), (64, 4), (200, 4), (130, 7)])
def test_bit_sliced_distances(n, radius):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**64, 8, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, 6), dtype=np.uint64), axis=1)
    prints = base[rng.integers(0, 8, n)] ^ np.where(rng.random(n) < 0.8, flips, np.uint64(0))
    q, j = simhash.within(simhash.planes(prints), n, prints, radius)
    got = set(zip(q.tolist(), j.tolist()))
    expected = {
        (a, b) for a in range(n) for b in range(n) if int(prints[a] ^ prints[b]).bit_count() <= radius
    }
    assert got == expected


def test_two_sides_of_a_large_bucket_are_compared(spark):
    # Most columns and queries are far from all others and are left out on the way.
    rng = np.random.default_rng(5)
    left = rng.integers(0, 2**64, 600, dtype=np.uint64)
    right = np.concatenate([left[:200] ^ np.uint64(6), rng.integers(0, 2**64, 600, dtype=np.uint64)])
    q, j = simhash.within(simhash.planes(right), len(right), left, 4)
    assert sorted(zip(q.tolist(), j.tolist())) == [(i, i) for i in range(200)]

    part = np.uint64(5)  # all share a piece, so they meet in one bucket of several sides
    prints = np.concatenate([left, right]) & ~np.uint64(8191) | part
    near = left[:200] & ~np.uint64(8191) | part
    prints = np.unique(np.concatenate([prints, near ^ np.uint64(1 << 40)])).view(np.int64)
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp long")
    links = [(r.u, r.v) for r in simhash.link_trees(frame, 4, block=500).collect()]
    bits = prints.view(np.uint64)
    apart = np.bitwise_count(bits[:, None] ^ bits[None, :])
    exact = [(int(prints[a]), int(prints[b])) for a, b in zip(*np.nonzero(np.triu(apart <= 4, 1)))]
    assert len(exact) >= 200
    everyone = prints.tolist()
    assert groups(links, everyone) == groups(exact, everyone)


def test_a_large_bucket_is_cut_into_cells(spark):
    rng = random.Random(3)
    first, prints = rng.getrandbits(63), set()
    at = first
    for _ in range(60):  # a chain in which each is 3 bits from the one before
        prints.add(at)
        for b in rng.sample(range(40), 3):
            at ^= 1 << b
    prints |= {rng.getrandbits(63) for _ in range(40)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.u, r.v) for r in simhash.link_trees(frame, 4, block=8).collect()]
    exact = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert all((a ^ b).bit_count() >= 0 for a, b in links)
    assert groups(links, prints) == groups(exact, prints)
    found = {r.node: r.root for r in simhash.components(frame.sparkSession.createDataFrame(links, "u long, v long")).collect()}
    wanted = groups(exact, prints)
    assert {n: found.get(n, n) for n in prints} == wanted


def test_keep_one_keeps_the_smallest_of_each_group(spark):
    frame = documents(spark)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    members = {}
    for r in simhash.near_duplicates(frame).collect():
        members.setdefault(r.root, []).append(r.doc_id)
    ids = lambda v: (v is None, v or 0)
    assert Counter(r[0] for r in kept.collect()) == Counter(min(m, key=ids) for m in members.values())


def test_the_pipeline_takes_buckets_of_two_sides(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join([*base[:i], "other", *base[i + 1 :]]) for i in range(0, 300, 5)]
    # One-word texts have the hash of the word; these share the last piece of the base.
    piece = simhash.fingerprint(" ".join(base).encode()) >> 52
    alone = (w for w in (f"w{i}" for i in range(1 << 23)) if xxhash.xxh64_intdigest(w, 42) >> 52 == piece)
    texts += [*itertools.islice(alone, 1100), *texts[:3]]
    prints = np.array([simhash.fingerprint(t.encode()) for t in texts], dtype=np.uint64)
    assert len(np.unique(prints[prints >> np.uint64(52) == piece])) > 1100
    near = np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4, 1)
    root = groups(zip(*np.nonzero(near)), range(len(texts)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_decontamination(spark):
    rng = random.Random(8)
    rows = texts()
    long = SPACED.findall(rows[8][1])
    common = " ".join(["the"] * 10)
    items = [
        (1, " ".join(long[100:130])), (2, " ".join(long[118:150]).upper()), (3, None), (4, ""),
        (5, "two, WORDS"), (6, "...!"), (7, prose(rng, 30)), (None, "word"), (1, "no id"), (8, common),
    ]
    rows = [*rows, (30, "The " * 30), (31, "the, the\nTHE " * 2)]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, n_hit string")
    windows = {}
    for item, text in items:
        w = PLAIN.findall(low(text or ""))
        for k in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    for options in ({}, {"block": 3, "segment_bytes": 2000}):
        got = decontamination.overlaps(documents(spark, rows), bench, **options).collect()
        got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got)
        expected = Counter()
        for doc, text in rows:
            w = PLAIN.findall(low(text or ""))
            hit, found = [0] * len(w), set()
            for length in {len(k) for k in windows}:
                for k in range(len(w) - length + 1):
                    if tuple(w[k : k + length]) in windows:
                        found |= windows[tuple(w[k : k + length])]
                        hit[k : k + length] = [1] * length
            expected[doc, len(w), sum(hit), tuple(sorted(str(f) for f in found if f is not None))] += 1
        assert got == expected
    kept = decontamination.decontaminate(documents(spark, rows), bench)
    clean = {d for d, _, hit, _ in expected if not hit} - {d for d, _, hit, _ in expected if hit}
    assert {r[0] for r in kept.collect()} == clean


def test_decontamination_by_row(spark, tmp_path):
    rng = random.Random(6)
    item = prose(rng, 12)
    rows = [(1, "clean"), (1, f"x {item}"), (None, item), (None, "clean"), (None, None), (None, "clean"), (2, "clean"), (3, item), (3, item), (4, "")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = documents(spark, rows)
    kept = corpus_pipeline.drop_contaminated(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns
    assert Counter((r[0], r[1]) for r in kept.collect()) == Counter(r for r in rows if item not in (r[1] or ""))


def test_proximity_matches(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (2, "a x b c d e"), (3, "a x x x b c d e")], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(9, "a b c d")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.overlaps(docs, bench, width=4, slop=1).collect()}
    assert rows[1].n_hit == 4 and rows[2].n_hit == rows[3].n_hit == 0
    assert [m.item for m in rows[2].near] == ["9"] * len(rows[2].near) and rows[2].near
    assert not rows[3].near


def test_proximity_matches_are_all_found_and_stay_in_their_text(spark):
    rng = random.Random(11)
    rows = [(0, "x y a"), (1, "x b c d"), (2, "b a c d"), (3, "a b c d"), (4, "b b c a d"), (5, "a x b c y d"), (6, ""), (7, None)]
    rows += [(i, " ".join(rng.choices("abcdx", k=rng.randint(1, 12)))) for i in range(8, 80)]
    bench = spark.createDataFrame([(9, "a b c d"), (10, "d c b a c")], "item_id long, text string")
    windows = [("9", list("abcd")), ("10", list("dcba")), ("10", list("cbac"))]
    for options in ({}, {"block": 1, "segment_bytes": 40}):
        got = decontamination.overlaps(documents(spark, rows), bench, width=4, slop=1, **options)
        got = {r.doc_id: {(m["item"], m["start"]) for m in r.near} for r in got.collect()}
        for doc, text in rows:
            words, expected = (text or "").split(), set()
            at = lambda p: words[p] if 0 <= p < len(words) else None
            for item, window in windows:
                n = range(-1, len(words) - 2)
                exact = {s for s in n if [at(s + k) for k in range(4)] == window}
                close = {s for s in n if all(any(at(s + k + o) == x for o in (-1, 0, 1)) for k, x in enumerate(window))}
                close = {s for s in close if not exact & {s - 1, s, s + 1}}
                expected |= {(item, max(s, 0)) for s in close if s - 1 not in close}
            assert got[doc] == expected, (doc, text)


def test_the_proximity_query_reports_changed_passages(spark, tmp_path):
    words = prose(random.Random(12), 24).split()
    changed = [w for i, x in enumerate(words) for w in ([x, "new"] if i % 8 == 7 else [x])]
    documents(spark, [(1, " ".join(words)), (2, " ".join(changed)), (3, "none")], clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r.doc_id: r for r in queries.op5_proximity(spark, str(tmp_path)).collect()}
    assert (rows[1].n_hit, rows[1].n_near, rows[2].n_hit, rows[2].near_items) == (24, 0, 0, "7")
    assert rows[2].n_near > 0 and rows[3].n_near == rows[3].n_near_items == 0


def repeats_by_hand(rows, depth=20):
    """(doc_id, words, removed, kept, maximal repeats), every window looked up by its words."""
    seen, expected = {}, Counter()
    for doc, text in rows:
        w = SPACED.findall(text or "")
        gone, runs = [False] * len(w), []
        for k in range(len(w) - depth + 1):
            window = tuple(w[k : k + depth])
            if window not in seen:
                seen[window] = (doc, k)
                continue
            gone[k : k + depth] = [True] * depth
            source, at = seen[window]
            if runs and [runs[-1][0] + runs[-1][1] - depth + 1, *runs[-1][2:]] == [k, source, at - (k - runs[-1][0])]:
                runs[-1][1] += 1
            else:
                runs.append([k, depth, source, at])
        kept = " ".join(a for a, g in zip(w, gone) if not g)
        expected[doc, len(w), sum(gone), kept, tuple(map(tuple, runs))] += 1
    return expected


def repeats_found(rows):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.text, tuple(map(tuple, r.repeats))) for r in rows)


def test_substring_dedup(spark):
    rows = [r for r in texts() if r[0] is not None]
    rows += [(40 + i, r[1]) for i, r in enumerate(rows) if r[0] in (8, 9)]
    got = substrings.remove_repeats(documents(spark, rows), segment=3000).collect()
    expected = repeats_by_hand(sorted(rows, key=lambda r: (r[0], r[1] or "")))
    assert repeats_found(got) == expected


def test_repeats_of_few_words_of_many_sources(spark):
    # Passages after one another, periodic text and few words: repeats meet, nest and overlap.
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (21, 25, 40, 60)]
    rows = [(i, " ".join(rng.choices([*passages, prose(rng, 7), "a b", "a"], k=rng.randint(1, 9)))) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choices("ab", k=80))) for i in range(20)]
    rows += [(200, "a " * 90), (201, "a b " * 50), (202, "a " * 30)]
    expected = repeats_by_hand(rows, 20)
    assert max(len(r[4]) for r in expected) > 5
    for segment, sample in ((500, 1 << 20), (1 << 20, 100)):
        frame = documents(spark, rng.sample(rows, len(rows))).repartition(3)
        assert repeats_found(substrings.remove_repeats(frame, segment=segment, sample=sample).collect()) == expected
    small = substrings.remove_repeats(documents(spark, rows), depth=3, stem=2, segment=500).collect()
    assert repeats_found(small) == repeats_by_hand(rows, 3)


def test_repeats_of_rows_that_share_an_id_do_not_go_by_the_order_of_the_input(spark):
    rng = random.Random(9)
    passage = prose(rng, 30)
    rows = [(1, f"{passage} {prose(rng, 5)}") for _ in range(6)] + [(1, passage)] * 40 + [(None, passage)] * 50
    rows += [(None, "few words")] * 30 + [(2, None)] * 3
    found = [
        repeats_found(substrings.remove_repeats(documents(spark, r).repartition(n), segment=300).collect())
        for r, n in ((rows, 2), (rows[::-1], 5), (rng.sample(rows, len(rows)), 3))
    ]
    assert found[0] == found[1] == found[2] and sum(found[0].values()) == len(rows)
    # One text of the first id keeps the passage; every other row loses it.
    whole = [r for r in found[0].elements() if r[0] != 2 and r[1] >= 30]
    assert sum(r[2] == 0 for r in whole) == 1 and len(whole) == 96
    assert all(r[2] >= 30 and r[4][0][2] == 1 for r in whole if r[2])
    assert found[0][None, 2, 0, "few words", ()] == 30 and found[0][2, 0, 0, "", ()] == 3


def test_rows_without_id_come_last_in_substring_dedup(spark):
    got = Counter()
    for r in substrings.remove_repeats(documents(spark)).collect():
        got[r.doc_id] += r.n_removed
    assert got[None] == 40 and got[9] == 0


def ids_of(text):
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "library"):
        ids_of.library = Tokenizer.from_file(packing.vocabulary())
    return [*ids_of.library.encode(text or "", add_special_tokens=False).ids, 2]


ODD = [
    "It's  DON'T we'll 'S x's <|endoftext|> a <|ENDOFTEXT|>b", "É́é H̱", "İstanbul ſ ×÷ aÃ", "a\x1cb c",
    "¿Qué «tal»? 12½ a_b", "Σας ΟΔΟΣ", "x y — “q” €5", "'re're ''s", "\r\n\t \x0b\x0c z", "a1b22c  !!! ?a", "À:é9é",
]


@pytest.mark.parametrize("length", [4096, 64])
def test_packing_is_a_round_trip(spark, length):
    rows = [*texts(), *[(50 + i, t) for i, t in enumerate(ODD)]]
    pieces = packing.concatenate_and_cut(documents(spark, rows), packing.vocabulary(), length)
    found = pieces.collect()
    at, sums = {}, Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert len(r.ids) == 4 * r.length and r.offset == sums[r.sequence_id]
        sums[r.sequence_id] += r.length
        at.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sorted(sums) == list(range(len(sums)))
    assert all(n == length for s, n in sums.items() if s < len(sums) - 1)
    line = [np.frombuffer(r.ids, "<u4").tolist() for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))]
    whole = Counter()
    for one, r in zip(line, sorted(found, key=lambda r: (r.sequence_id, r.offset))):
        if r.start == 0:
            now, body = r.doc_id, []
        body += one
        if r.start + r.length == r.doc_tokens:
            whole[now, tuple(body)] += 1
    assert whole == Counter((d, tuple(ids_of(t))) for d, t in rows)
    if length == 64:
        packed = packing.sequences(pieces, length).collect()
        assert {len(r.ids) // 4 for r in packed if r.sequence_id < len(sums) - 1} == {64}
        last = max(packed, key=lambda r: r.sequence_id)
        assert len(last.ids) // 4 == (64 if last.n_ids & (last.n_ids - 1) else last.n_ids)
        assert all(r.bounds[-1] == r.n_ids == sums[r.sequence_id] for r in packed)


def one_by_one(sizes, length):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in range(len(rooms)) if rooms[b] >= s]
        if fit:
            rooms[min(fit, key=lambda b: rooms[b])] -= s
        else:
            rooms.append(length - s)
    return sorted(rooms)


def test_best_fit_decreasing_equals_one_by_one():
    rng = random.Random(3)
    for _ in range(400):
        length = rng.choice([8, 16, 37, 64])
        some = rng.sample(range(1, length), rng.randint(1, min(7, length - 1)))
        counts = {s: rng.randint(1, 9) for s in some}
        runs, opened = binary_output.best_fit_decreasing(counts, length)
        inside, seen = {}, Counter()
        for size, rank, count, first, each, base in runs:
            assert rank == seen[size]
            seen[size] += count
            for i in range(count):
                inside.setdefault(first + i // each, []).append((base + i % each * size, size))
        assert seen == counts and sorted(inside) == list(range(opened))
        rooms = []
        for held in inside.values():
            held.sort()
            assert [o for o, _ in held] == [sum(s for _, s in held[:i]) for i in range(len(held))]
            rooms.append(length - sum(s for _, s in held))
        assert sorted(rooms) == one_by_one([s for s, n in counts.items() for _ in range(n)], length)


def test_token_matrices_are_a_round_trip(spark):
    rows = texts()
    found = binary_output.matrices(documents(spark, rows), packing.vocabulary(), 128).collect()
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    parts = []
    for r in found:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == 128 and r.bounds[-1] == r.n_ids <= 128
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.bounds, r.bounds[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.append((doc, start, tuple(ids[a:b].tolist())))
    expected = Counter()
    for doc, text in rows:
        ids = ids_of(text)
        for k in range(0, len(ids), 128):
            expected[doc, k, tuple(ids[k : k + 128])] += 1
    assert Counter(parts) == expected


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


PII_BITS = ["1", "23", "456", "7890123456", ".", ".", " ", "-", "+", "(", ")", "@", "@", "a", "b.c", "é", "%",
            "4111111111111111", "00", " x ", "255", "300"]
SECRET_BITS = ["token", "Token", "ſecret", "passwd", "api_key", "APIKEY", " ", "=", ":", "'", '"', "abcdef", "AKIA",
               "ABCD1234EFGH5678", "0123456789abcdef", "x.y", "  ", "é", "password"]


def test_base_spans_are_the_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choices(PII_BITS, k=rng.randint(0, 24)))
        assert pii.base_spans(text) == plain_pii(text)
        text = "".join(rng.choices(SECRET_BITS, k=rng.randint(0, 20)))
        assert secret_scan.base_spans(text) == plain_secrets(text)


def plain_secrets(t):
    rule = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [("assign", *m.span()) for m in re.finditer(rule, t, re.I | re.A) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]


def test_long_runs_take_linear_time():
    pii.base_spans("a" * 10**6 + "1" * 10**6 + "." * 10**5 + "@" * 10**5 + "a@" * 10**5 + "+1(" * 10**5)
    pii.proposals("a" * 10**6 + "1" * 10**6 + "AB12" * 10**5 + "a (" * 10**5)
    secret_scan.secrets("A1b2" * 10**5 + " " * 10**5 + "token" * 10**5, secret_scan.vocabulary(), 2.0)


def joined(found, kinds):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (s[1], kinds.index(s[0]))))


def test_personal_data(spark):
    rows = [*texts(), *[(100 + i, f"Please call phone (555) 22{i}-45{i}7 soon, Dr. Anna Berg") for i in range(10)]]
    found = pii.digests(pii.find(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    bases = Counter()
    for doc, text in rows:
        base = plain_pii(text or "")
        counts = Counter(k for k, _, _ in base)
        bases[doc, *(counts[k] for k in pii.BASE), hashlib.sha256(joined(base, pii.KINDS).encode()).hexdigest()] += 1
    assert bases == Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found)
    spans_of = {r.doc_id: r.spans for r in found}
    assert spans_of[16].split(",") == [s for s in joined(plain_pii(dict(rows)[16]), pii.KINDS).split(",")]
    assert spans_of[100] == "phone:18:32,person:39:52"
    assert spans_of[5] == spans_of[0] == ""


def test_label_model_finds_the_unreliable_labeler():
    rng = np.random.default_rng(0)
    real = rng.random(4000) < 0.5
    right = [0.95, 0.9, 0.55, 0.9, 0.85]
    votes = np.array([np.where(rng.random(4000) < p, real, ~real) for p in right]).T * 2 - 1
    rows, n = np.unique(votes, axis=0, return_counts=True)
    model = pii.LabelModel(np.zeros(len(rows), int), rows, n.astype(float))
    truth = {tuple(v): 0 for v in rows.tolist()}
    guess = dict(zip(map(tuple, rows.tolist()), model.posterior(np.zeros(len(rows), int), rows) > 0.5))
    assert np.mean([guess[tuple(v)] == r for v, r in zip(votes.tolist(), real)]) > 0.97
    assert len(truth) == len(guess)
    strength = model.table[:, 2, 0] / model.table[:, 2, 1]
    assert strength.argmin() == 2


def test_secrets(spark):
    rows = texts()
    found = secret_scan.find(documents(spark, rows), secret_scan.vocabulary()).collect()
    assert len(found) == len(rows)
    bases = Counter()
    for doc, text in rows:
        base = plain_secrets(text or "")
        counts = Counter(k for k, _, _ in base)
        bases[doc, *(counts[k] for k in secret_scan.BASE), hashlib.sha256(joined(base, secret_scan.KINDS).encode()).hexdigest()] += 1
    assert bases == Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found)
    assert [r.spans for r in found if r.doc_id == 18 and r.spans] == ["random:5:37"]
    assert [r.spans for r in found if r.doc_id in (5, 8, 15)] == [""] * 3


@pytest.mark.parametrize("run, secret", [
    ("d41d8cd98f00b204e9800998ecf8427e", False), ("123e4567-e89b-12d3-a456-426614174000", False),
    ("getUserAccountName2024Value", False), ("some_long_identifier_name_v2", False),
    ("1234567890123456789012", False), ("https/example/path/index2", False),
    ("ghp_CNXXFw91mL1Rp5BcZ6yPBiGyTHkkqxQCgEFR", True), ("cTTOi7dQG6xtI1N2/4nKdjo4brtZ3J6Y", True),
])
def test_token_efficiency(run, secret):
    found = secret_scan.costly(f"see {run} there", secret_scan.vocabulary(), 2.0)
    assert found == ([("random", 4, 4 + len(run))] if secret else [])


@pytest.mark.parametrize("letters", [string.ascii_lowercase, string.ascii_uppercase, BASE36, BASE36.upper()])
@pytest.mark.parametrize("size", [16, 20, 32])
def test_random_strings_of_few_kinds_are_secrets(letters, size):
    rng = random.Random(size)
    runs = ["".join(rng.choices(letters, k=size)) for _ in range(400)]
    found = secret_scan.costly(" ".join(runs), secret_scan.vocabulary(), 2.0)
    assert len(found) >= 0.96 * len(runs)


def test_words_of_any_length_are_no_secrets():
    runs = """internationalization antidisestablishmentarianism characteristically telecommunications
        Donaudampfschifffahrtsgesellschaft Bundesverfassungsgericht constitutionnellement
        anticonstitucionalmente INTERNATIONALIZATION MAX_CONNECTION_POOL_SIZE HAVE_SYS_EVENT_H
        HTMLParserFactoryBean2 x86_64-linux-gnu-gcc-12 org/apache/spark/sql s3-2024-10-12-0001
        kubernetes-dashboard-v2 ================ xxxxxxxxxxxxxxxxxxxx"""
    assert secret_scan.costly(runs, secret_scan.vocabulary(), 2.0) == []


def test_masking_keeps_all_rows_and_columns(spark):
    frame = documents(spark)
    out = secret_scan.redact(frame, secret_scan.vocabulary())
    assert out.columns == frame.columns and out.count() == frame.count()
    rows = {r[0]: (r[1], r[4]) for r in out.collect()}
    assert rows[17] == ("[SECRET] [SECRET]", 17) or rows[17][0].count("[SECRET]") == 2
    assert rows[5][0] == dict(texts())[5] and rows[0] == (None, None)


def test_crc_of_pieces(spark):
    rows = [(1, "one two three"), (2, None)]
    found = packing.concatenate_and_cut(documents(spark, rows), packing.vocabulary(), 2, digest=True).collect()
    for r in found:
        ids = ids_of(dict(rows)[r.doc_id])
        assert r.ids == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4"))
