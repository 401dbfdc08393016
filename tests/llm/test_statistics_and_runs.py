"""Periodic runs, token alignment and quality outliers against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rowsmith.llm import alignment, periodic, quality, queries
from tests.llm.cases import SPACED, documents, prose, texts


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs ---------------------------------------------------------------------


def plain_runs(words: list, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period): every maximal stretch, found period by period."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    rows = texts()
    for i in range(60):
        words = rng.choices("ab" if i % 2 else "abcde", k=rng.randint(0, 60))
        at, p = rng.randint(0, len(words)), rng.randint(1, 9)
        rows.append((100 + i, " ".join(words[:at] + words[at : at + p] * rng.randint(1, 9) + words[at + p :])))
    rows += [(200, "a " * 3000), (201, "x y " * 700 + "x"), (202, "p q r s t u"), (203, "a a a a a"),
             (204, "a a a a a a"), (205, "u v u v u v u v"), (206, "u v u v u v u")]
    return rows


def test_runs_of_random_rows():
    rng = random.Random(8)
    for _ in range(300):
        rows = []
        for _ in range(rng.randint(0, 4)):
            row = rng.choices(range(rng.choice((1, 2, 3))), k=rng.randint(0, 40))
            p = rng.randint(1, 8)
            rows.append(row + row[:p] * rng.randint(0, 6))
        line, want = [-1], []
        for k, row in enumerate(rows):
            want += [(s + len(line), s + n + len(line), q) for s, n, q in plain_runs(row)]
            line += [*row, -2 - k]
        got = periodic.runs_of(np.array(line), max(map(len, rows), default=0))
        assert [tuple(r) for r in got.tolist()] == want


def test_extension_on_both_sides():
    rng = random.Random(4)
    row = [-1, *rng.choices(range(2), k=300), -2]
    grammar = periodic.Grammar(np.array(row))
    i, j = (np.array(x) for x in zip(*[rng.sample(range(1, 301), 2) for _ in range(500)]))
    for to_left in (False, True):
        step = -1 if to_left else 1
        for a, b, n in zip(i, j, grammar.extension(i, j, to_left)):
            k = 0
            while row[a + step * k] == row[b + step * k]:
                k += 1
            assert n == k


def test_find_runs(spark):
    rows = periodic_texts()
    found = periodic.find_runs(documents(spark, rows)).collect()
    want = Counter()
    for i, text in rows:
        words = SPACED.findall(text or "")
        runs = plain_runs(words)
        want[(i, len(words), tuple(runs), collapsed(words, runs))] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.text) for r in found) == want


def test_find_runs_of_nothing(spark):
    assert periodic.find_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(documents(spark, []), exponent=3)


def test_op13(spark, tmp_path):
    rows = periodic_texts()
    documents(spark, rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, text in rows:
        words = SPACED.findall(text or "")
        n = len(words)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        head = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want[(i, len(runs), *head, sha(listed), sha(collapsed(words, runs)))] += 1
    assert Counter(tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()) == want
    assert sum(1 for r in want if r[1]) > 20


# -- token alignment -------------------------------------------------------------------


def library():
    import sentencepiece
    from tokenizers import Tokenizer

    one, other = alignment.vocabularies()
    a = Tokenizer.from_file(one)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=other), alignment._byte_letters()


def plain_alignment(tools, text):
    """(A ids, B ids, groups, links) by comparing every A with every B token."""
    a, b, letters = tools
    nothing = [], [], [], []
    if not text:
        return nothing
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for piece in map(b.id_to_piece, ids_b):
        byte = piece.startswith("<0x") and len(piece) == 6
        bytes_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return nothing
    ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
    spans_a = list(zip([0, *ends_a], ends_a))
    spans_b = list(zip([0, *ends_b], ends_b))
    links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans_a)
             for j, (u, v) in enumerate(spans_b) if max(s, u) < min(e, v)]
    groups, low, lower = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, ids_a[low:i])) + "|" + ",".join(map(str, ids_b[lower:j])))
        low, lower = i, j
    return ids_a, ids_b, groups, links


def awkward_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    letters = [*"ab  '1é日▁ \n\t,́<𝔘\x00", "the", "<|endoftext|>", "<0x41>"]
    odd = [" ", "  a", "a ", "a  b", "x▁y z", "<s> <unk> <0x41> <|endoftext|> b",
           "日本語 テ スト 𝔘 ok", "a  b　 c  d", "don 't it's 's", "\t\n a\n b",
           "a\x00 b \x1c c", "́ a ́b", "1 2 33 ,, ,"]
    odd += ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(300)]
    short = [(i, None if t is None else t[:1500]) for i, t in texts()]
    return short + [(300 + k, t) for k, t in enumerate(odd)]


def test_gallop():
    rng = np.random.default_rng(2)
    longer = np.cumsum(rng.integers(1, 4, 5000))
    wanted = np.sort(rng.choice(np.arange(1, longer[-1] + 1), 900, replace=False))
    got = alignment.intersect(wanted, longer, np.zeros(len(wanted), np.int64))
    assert (got == np.searchsorted(longer, wanted)).all()


@pytest.mark.parametrize("cuts", [True, False])
def test_pieces_do_not_change_ids(cuts):
    """With and without cutting texts the ids are those of the whole text."""
    tools, pair = library(), alignment.Pair(*alignment.vocabularies(), most=200)
    pair.cuts = cuts
    from rowsmith.llm.words import blocks
    import pyarrow as pa

    rows = awkward_texts()
    for first, data, offsets in blocks(pa.array([t for _, t in rows]), 1 << 12):
        found = alignment.Aligned(pair, data, offsets)
        shown = found.groups()
        for k in range(len(offsets) - 1):
            a, b, groups, links = plain_alignment(tools, rows[first + k][1])
            assert shown[k].decode() == ";".join(groups), rows[first + k]
            assert (found.n_a[k], found.n_b[k], found.n_links[k]) == (len(a), len(b), len(links))


def test_op12(spark, tmp_path):
    rows, tools = awkward_texts(), library()
    documents(spark, rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    plain = [(i, *plain_alignment(tools, text)) for i, text in rows]
    count = Counter(link for row in plain for link in set(row[4]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    want = Counter(
        (i, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[0]] for x in links),
         sum(count[x] for x in links), sha(";".join(groups)) if groups else "")
        for i, a, b, groups, links in plain
    )
    got = queries.op12_token_alignment(spark, str(tmp_path)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    assert Counter(tuple(r) for r in got.collect()) == want


def test_align_nothing(spark):
    paths = alignment.vocabularies()
    assert alignment.align(documents(spark, []), paths).count() == 0
    blank = alignment.align(documents(spark, [(1, None), (None, "")]), paths).collect()
    assert {(r.n_a, r.n_links, r.count_sum, r.groups) for r in blank} == {(0, 0, 0, "")}


# -- quality outliers ------------------------------------------------------------------


def plain_statistics(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = SPACED.findall(text)
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
            len(lines) - len(set(lines)), len(repeated))


def junk_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(6)
    rows = texts() + [(21, "a\n\nb\n a\na\n#*\n" * 3), (22, "x y z " * 40), (23, "né ñ\r\nné ñ\r\n$")]
    rows += [(100 + i, prose(rng, rng.randint(50, 300))) for i in range(150)]
    return rows + [(300 + i, " ".join(w + "$$$" for w in prose(rng, 90).split())) for i in range(50)]


def test_statistics_and_verdicts(spark):
    rows = junk_texts()
    found = quality.judge(documents(spark, rows)).collect()
    got = Counter((r.doc_id, *(r[c] for c in quality.COUNTS), r.base_failed) for r in found)
    want = Counter()
    for i, text in rows:
        s = plain_statistics(text)
        want[(i, *s, s[0] < 50 or 100 * s[5] > 50 * s[0])] += 1
    assert got == want
    for r in found:
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and r.doc_id >= 100 and not r.base_failed:
            assert r.kept == (r.doc_id < 300), r


def test_half_junk_does_not_move_the_centre():
    """45 % far off, all to one side: the classical centre lies between, the robust one not."""
    rng = np.random.default_rng(1)
    clean, junk = rng.normal(0, 1, (550, 4)), rng.normal(9, 0.3, (450, 4))
    points = np.concatenate([clean, junk])
    products = np.stack([points[:, i] * points[:, j] for i, j in quality._UPPER], axis=1)
    centre, scatter = quality.robust(np.ones(len(points)), points, products)
    assert np.abs(centre).max() < 0.3
    assert np.abs(np.diag(scatter) - 2).max() < 0.8  # one of their own, one of the floor
    assert (quality._distances(junk, centre, scatter) > quality.chi_squared_quantile(0.9999, 4)).all()


def test_cells_count_with_their_sums():
    """The same vectors, one by one and joined to cells of one place."""
    rng = np.random.default_rng(5)
    base = rng.normal(0, 2, (80, 4))
    times = rng.integers(1, 6, 80)
    one = np.repeat(base, times, axis=0)

    def fit(points, count):
        products = np.stack([points[:, i] * points[:, j] for i, j in quality._UPPER], axis=1)
        return quality._moments(count.astype(float), points, products)

    for x, y in zip(fit(one, np.ones(len(one))), fit(base, times)):
        assert np.allclose(x, y)


def test_chi_squared():
    assert math.isclose(quality.chi_squared(9.487729, 4), 0.95, abs_tol=1e-6)
    assert math.isclose(quality.chi_squared_quantile(0.95, 4), 9.487729, abs_tol=1e-5)


def test_judge_small_and_empty_tables(spark):
    assert quality.judge(documents(spark, [])).count() == 0
    rng = random.Random(2)
    few = quality.judge(documents(spark, [(k, prose(rng, 80)) for k in range(3)])).collect()
    assert [r.kept for r in few] == [True] * 3


def test_many_groups_are_joined_in_shares(spark, monkeypatch):
    """Beyond the size that is broadcast, rows and models meet by a salted join."""
    rows = junk_texts()
    one = quality.judge(documents(spark, rows)).collect()
    monkeypatch.setattr(quality, "BROADCAST", 0)
    other = quality.judge(documents(spark, rows)).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, other))
