"""The parallel matching against the serial loop it must equal."""

from __future__ import annotations

import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowsmith.functions import similarity
from rowsmith.operators import matching, nearest
from rowsmith.session import cut_lineage

RECORD = "row_idx bigint, student_id string, name string, department string"


def serial(source, target, threshold, boost):
    """Serve the source records one after another."""
    offered, used, out = {}, set(), []
    for _, key, name, team in sorted(target):
        if key.strip():
            offered.setdefault(key.strip(), (" ".join(name.lower().split()), team.strip().lower()))
    for _, key, name, team in sorted(source):
        key, name, team = key.strip(), " ".join(name.lower().split()), team.strip().lower()
        if key in offered and key not in used:
            used.add(key)
            out.append((key, "exact_key", "1.000"))
            continue
        best, partner = 0.0, ""
        for other, (other_name, other_team) in offered.items() if name else ():
            if other in used:
                continue
            score = SequenceMatcher(None, name, other_name).ratio() if other_name else 0.0
            if boost and team and team == other_team:
                score = min(1.0, score + 0.06)
            if score > best:
                best, partner = score, other
        if partner and best >= threshold:
            used.add(partner)
            out.append((partner, "fuzzy_name", f"{best:.3f}"))
        else:
            out.append(("", "no_match", f"{best:.3f}"))
    return out, set(offered) - used


def crowd(seed, size, names, typos, letters, same_order=False, teams=("a", "b", "c", ""), blank=0.05):
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))

    pool = [f"{word()} {word()}" for _ in range(names)]

    def record(i):
        name = rng.choice(pool)
        if rng.random() < typos:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice(letters + " ") + name[at + rng.randint(0, 1):]
        if rng.random() < blank:
            name = ""
        if rng.random() < 0.1:
            name = f"  {name.upper()} "
        key = f"K{i if same_order else rng.randint(0, size)}"
        return (i, "" if rng.random() < 0.3 else key, name, rng.choice(teams))

    return [record(i) for i in range(size)], [record(i) for i in range(size)]


def check(spark, source, target, threshold=0.86, boost=True):
    result = matching.fuzzy_match(
        spark.createDataFrame(source, RECORD),
        spark.createDataFrame(target, RECORD),
        name_columns=["name"],
        department_column="department" if boost else "",
        threshold=threshold,
    )
    expected, left = serial(source, target, threshold, boost)
    rows = result.decisions.orderBy("row_idx").collect()
    got = [(r.target_record_key, r.match_type, r.match_score) for r in rows]
    assert got == expected
    assert {r.target_record_key for r in result.unmatched_targets.collect()} == left
    used = [k for k, _, _ in got if k]
    assert len(used) == len(set(used))
    summary = result.summary.first()
    kinds = Counter(m for _, m, _ in got)
    assert summary.exact_key == kinds["exact_key"]
    assert summary.fuzzy_name == kinds["fuzzy_name"]
    assert summary.target_unmatched_records == len(left)
    return rows


@pytest.fixture
def small_limits(monkeypatch):
    """Make every large-input path run on small inputs."""
    monkeypatch.setattr(matching, "RANGE", 7)
    monkeypatch.setattr(matching, "BLOCK", 4)


def test_hand_checked_records(spark):
    source = [
        (1, "", "Jacob Obi", "Civil"),
        (2, "T1", "Jacob Obi", "Civil"),
        (3, "T2", "Jakob Obi", "Civil"),
        (4, "T3", "", "Law"),
        (5, "Z9", "", ""),
        (6, "", "", ""),
        (7, "", "MARY  nwosu", "Law"),
    ]
    target = [
        (1, "T1", "Jacob Obi", "Civil"),
        (2, "T2", "Jakob Obi", "Civil"),
        (3, "T3", "Mary Nwosu", "Law"),
        (4, "T2", "Dup Row", "Law"),
        (5, "", "No Key", "Law"),
    ]
    rows = check(spark, source, target)
    assert [r.reason for r in rows] == [
        "Name similarity match",
        "Name similarity match",
        "Source key 'T2' not present in target and best candidate score 0.211 below threshold 0.86",
        "Key match",
        "Source key 'Z9' not present in target and no usable source name fields for fuzzy match",
        "No usable source name fields for fuzzy match",
        "Best candidate score 0.000 below threshold 0.86",
    ]


def test_contended_names(spark):
    check(spark, *crowd(3, 40, 8, 0.4, "abcdef"))


def test_large_input_paths(spark, small_limits):
    source, target = crowd(4, 60, 40, 0.6, "abcdefgh")
    check(spark, source, target)


def test_without_department(spark):
    check(spark, *crowd(5, 60, 40, 0.5, "abcdefghij"), threshold=0.8, boost=False)


def test_hot_name_with_owners_in_order(spark, small_limits):
    source, target = crowd(7, 300, 1, 0.0, "abcdefgh", same_order=True, blank=0.0)
    check(spark, source, target)


def test_hot_name_with_owners_in_any_order(spark):
    source, target = crowd(11, 40, 1, 0.0, "abcdefgh", teams=("a", ""), blank=0.0)
    check(spark, source, target)


def test_thresholds_out_of_range(spark):
    empty = spark.createDataFrame([], RECORD)
    for threshold in (-0.1, 1.1):
        with pytest.raises(ValueError):
            matching.fuzzy_match(empty, empty, name_columns=["name"], threshold=threshold)


def test_gram_filter_loses_no_pair():
    rng = random.Random(1)
    for _ in range(4000):
        letters = rng.choice(["ab", "abcdef", "abcdefghijklmnop "])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(1, 24)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = rng.choice(letters)
        b = "".join(b) or "a"
        ratio = SequenceMatcher(None, a, b).ratio()
        for at_least in (0.3, 0.7, 0.8, 0.86, 0.94, 1.0):
            if ratio < at_least:
                continue
            q = similarity.gram_size(at_least)

            def grams(text):
                padded = "\x02" * (q - 1) + text + "\x03" * (q - 1)
                return Counter(padded[i:i + q] for i in range(len(padded) - q + 1))

            common = sum((grams(a) & grams(b)).values())
            bound = similarity.overlap_bound(len(a), len(b), at_least, q)
            assert 1 <= bound <= common
            assert similarity.least_overlap(len(a), at_least, q) <= bound
            assert similarity.least_overlap(len(b), at_least, q) <= bound


@pytest.mark.parametrize("at_least", [0.0, 1e-6, 0.1, 0.3, 0.7, 0.8, 0.86, 0.94, 1.0])
def test_grams_and_prefix_lengths(at_least):
    q = similarity.gram_size(at_least)
    names = ["abab" * 3 + "x" * n for n in range(20)] + ["a", "", "\U0001d518 é"]
    salts = np.zeros(len(names), np.int64)
    found, first = similarity.grams(names, salts, at_least)
    hashes = {}
    for k, name in enumerate(names):
        padded = "\x02" * (q - 1) + name + "\x03" * (q - 1)
        plain = [padded[i : i + q] for i in range(len(padded) - q + 1)] if name else []
        seen = Counter()
        for gram, value in zip(plain, found[first[k] : first[k + 1]].tolist(), strict=True):
            seen[gram] += 1
            assert hashes.setdefault((gram, seen[gram]), value) == value
    assert len(set(hashes.values())) == len(hashes)
    # Frequent grams come last; as many are kept as a pair may lack, and one.
    common = np.sort(found[:5])
    kept, edges = similarity.indexed(names, salts, at_least, (common, np.arange(9, 9 + len(common))))
    for k, name in enumerate(names):
        mine, n = kept[edges[k] : edges[k + 1]].tolist(), len(name)
        if not name:
            assert mine == []
            continue
        want = n + q - 1 if at_least == 0 else n + q - similarity.least_overlap(n, at_least, q)
        assert len(mine) == max(1, want)
        left = set(found[first[k] : first[k + 1]].tolist()) - set(mine)
        often = dict(zip(common.tolist(), range(9, 20)))
        worst = max((often.get(g, 0), g) for g in mine)
        assert all((often.get(g, 0), g) > worst for g in left)


def test_salts_keep_names_apart():
    value, first = similarity.grams(["same", "same"], np.array([1, 2]), 0.86)
    assert not set(value[: first[1]].tolist()) & set(value[first[1] :].tolist())


@pytest.mark.parametrize("letters, low, high", [
    ("ab", 0, 12), ("abcdefgh ", 0, 30), ("abcdefghijklmnop ", 40, 150), ("abc", 150, 420), ("aé日\U0001d518", 0, 9),
])
def test_batch_ratio_equals_the_library(letters, low, high):
    rng = random.Random(high)

    def word():
        return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    left = [word() for _ in range(150)]
    right = [a[: len(a) // 2] + word() if rng.random() < 0.5 else word() for a in left] + left[:9]
    one, other = similarity.Names(left), similarity.Names(right)
    i = np.array([rng.randrange(len(left)) for _ in range(400)])
    j = np.array([rng.randrange(len(right)) for _ in range(400)])
    got, bound = similarity.ratios(one, i, other, j), similarity.upper_bound(one, i, other, j)
    for a, b, r, u in zip(i, j, got, bound):
        want = SequenceMatcher(None, left[a], right[b]).ratio() if left[a] and right[b] else 0.0
        assert r == want
        assert u >= r - 1e-12


def test_places_after_a_free_target_spread_over_ranges(spark, small_limits):
    source = [(i, "", "same name" if i % 2 else "same nama", "a") for i in range(60)]
    target = [(i, f"K{i}", "same name" if i % 2 else "same nama", "a") for i in range(70)]
    check(spark, source, target, threshold=0.8)


def test_grams_of_names_are_not_broadcast(spark):
    # The planner knows the size of the names, not that of their grams.
    rows = [(f"name of {i}", "physics") for i in range(20)]
    names = cut_lineage(spark.createDataFrame(rows, "nk string, dk string"))
    offered = names.withColumnRenamed("nk", "tnk")
    for within in (None, "dk"):
        wanted = names if within else names.select("nk")
        pairs = matching.similar_names(wanted, offered if within else offered.select("tnk"), 0.9, within)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_similar_names_equals_all_pairs(spark):
    source, target = crowd(2, 60, 25, 0.6, "abcde")
    left = sorted({" ".join(n.lower().split()) for _, _, n, _ in source} - {""})
    right = sorted({" ".join(n.lower().split()) for _, _, n, _ in target} - {""})
    for at_least in (0.6, 0.8, 0.94):
        expected = {
            (a, b, SequenceMatcher(None, a, b).ratio())
            for a in left
            for b in right
            if SequenceMatcher(None, a, b).ratio() >= at_least
        }
        pairs = matching.similar_names(
            spark.createDataFrame([(a,) for a in left], "nk string"),
            spark.createDataFrame([(b,) for b in right], "tnk string"),
            at_least,
        )
        assert {tuple(r) for r in pairs.select("nk", "tnk", "ratio").collect()} == expected


def test_long_texts_keep_the_reference_ratio(spark):
    a, b = "ab" * 150 + "xyz", "ab" * 140 + "xyw" + "b" * 20
    row = (
        spark.createDataFrame([(a, b), ("", b)], "a string, b string")
        .select(similarity.ratio(F.col("a"), F.col("b")).alias("r"))
        .collect()
    )
    assert [r.r for r in row] == [SequenceMatcher(None, a, b).ratio(), 0.0]


def test_no_unbounded_joins(spark):
    names = spark.range(50).selectExpr("cast(id as string) nk")
    pairs = matching.similar_names(names, names.withColumnRenamed("nk", "tnk"), 0.8)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Join Inner\n" not in plan


@pytest.mark.parametrize("threshold", [0.0, 0.06])
def test_thresholds_that_equal_departments_reach(spark, threshold):
    """Names without a common letter, and blank ones, match by department alone."""
    source, target = crowd(9, 5, 4, 0.4, "abcdefghijklmnopqrstuvw", teams=("a", "b", ""), blank=0.2)
    target += [(50, "L1", "", "a"), (51, "L2", "9999", "b"), (52, "L3", "", "")]
    source += [(60, "", "zzzz", "a"), (61, "", "zz", "b"), (62, "", "yyy", "")]
    check(spark, source, target, threshold=threshold)


def test_search_half_way_down(spark, monkeypatch):
    """Many free names are searched at a level between before the threshold's own."""
    levels, settle = [], matching._Assignment.settle
    monkeypatch.setattr(matching, "MANY", 0)
    monkeypatch.setattr(
        matching._Assignment, "settle", lambda self, level: (levels.append(level), settle(self, level))
    )
    check(spark, *crowd(6, 40, 30, 0.6, "abcdefgh"), threshold=0.7)
    assert levels == [1.0, 0.85, 0.7]


def test_high_levels_use_long_grams():
    assert similarity.gram_size(0.94) == 6 and similarity.gram_size(0.86) == 4


def test_words_and_numbers_share_no_class():
    digits, words = similarity.Names(["0123456789 0123"]), similarity.Names(["pqrstuvwxy klmn"])
    at = np.array([0])
    assert similarity.upper_bound(digits, at, words, at).tolist() == [2 / 30]


def nodes_of(names, size, teams, until):
    rows = pd.DataFrame({"tnk": names, "tdk": teams, "until": until})
    numbered = rows.assign(node=np.arange(len(rows)) // size)
    return pd.concat([nearest._summary(part) for _, part in numbered.groupby("node")])


def test_nodes_that_cannot_be_better_are_not_searched():
    """Numbers share the space with every word, so one node settles them."""
    rng = random.Random(1)
    words = ["".join(rng.choice("aeioulnrstmdbkgv") for _ in range(8)) + " x" for _ in range(400)]
    nodes = nodes_of(words, 20, "a", 99)
    groups = pd.DataFrame({
        "nk": ["12345678 9", "aeioulnr x"], "dk": "a", "first_s": 1, "last_s": 1,
        "best": [2 * 1 / 20 + 0.06, 0.5],
    })
    schema = pa.schema([("nk", pa.string()), ("node", pa.int64())])
    asked, summaries = pa.Table.from_pandas(groups), pa.Table.from_pandas(nodes)
    found = nearest._chosen(0.06, False, schema)(asked, summaries).to_pandas()
    assert set(found["nk"]) == {"aeioulnr x"}
    first = nearest._chosen(0.06, True, schema)(
        pa.Table.from_pandas(groups.assign(best=0.0)), summaries
    ).to_pandas()
    assert sorted(first["nk"]) == ["12345678 9", "aeioulnr x"]


@pytest.mark.parametrize("boost", [0.0, 0.06])
def test_best_offers_equal_all_pairs(spark, monkeypatch, boost):
    for name, small in (("NODE", 7), ("ASKED", 9), ("NODES", 4)):
        monkeypatch.setattr(nearest, name, small)
    rng = random.Random(8)

    def word(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) or "a"

    asked = {(word(rng.choice(["abc ", "12 3", "é日x"])), rng.choice(["", "p", "q"])) for _ in range(40)}
    asked = [(n, d, a, a + rng.choice([0, 0, 40])) for n, d in sorted(asked) for a in [rng.randint(0, 99)]]
    offered = sorted({(word("abcdx1 é"), rng.choice(["", "p", "q", "r"])) for _ in range(90)})
    offered = [(n, d, rng.choice([rng.randint(0, 140), (1 << 63) - 1])) for n, d in offered]
    steps = nearest.best_offers(
        spark.createDataFrame(asked, "nk string, dk string, first_s long, last_s long"),
        spark.createDataFrame(offered, "tnk string, tdk string, until long"), boost,
    ).collect()
    for name, team, first, last in asked:
        for s in {first, last}:
            want = max([0.0] + [
                min(1.0, SequenceMatcher(None, name, other).ratio() + boost * (team == theirs != ""))
                for other, theirs, until in offered if until > s
            ])
            mine = [r.score for r in steps if (r.nk, r.dk) == (name, team) and r.until > s]
            assert max(mine, default=0.0) == want, (name, team, s)
