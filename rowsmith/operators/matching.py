"""One-to-one matching of records whose keys are missing or inconsistent.

The result is that of serving the source records in order: each takes the free
target with its own key, else the free target with the most similar name (the
earlier one among equals), if the score reaches the threshold.

It is computed in parallel by deferred acceptance.  All targets prefer the
earlier source, so the stable matching is unique and equals the serial result:
free sources propose to their best target that is free or held by a later
source, every target keeps the earliest proposer, and the displaced ones propose
again.  Three things keep the rounds small:

* names are compared, not records: records that share a name share its edges;
* the free sources of one name (and department) propose together, each to a place
  of its own on their common list, so equal names need no pairs, and most names
  are settled in one step from ranks alone;
* the targets of a name are kept in blocks of consecutive ordinals, and only the
  blocks the proposers can reach are expanded to records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import fmt3
from ..functions.similarity import DEPARTMENT_BOOST, gram_column, ratio
from ..functions.text import join_name, name_key, norm, quoted
from ..session import cut_lineage, dropped
from .dedupe import index_by, index_counts
from .nearest import best_offers

DECISION_COLUMNS = (
    "source_record_key",
    "source_name",
    "source_department",
    "target_record_key",
    "target_name",
    "target_department",
    "match_type",
    "match_score",
    "reason",
)

ANY = "*"  # department of a proposer group whose list ignores departments
BLOCK = 1024  # target records per block
RANGE = 1 << 16  # ordinals that one window task numbers at most
FREQUENT = 200_000  # grams whose counts are told to all tasks, at most
SELDOM = 16  # grams of so many names are not frequent
MANY = 10_000  # free names for which a search half way down is worth its rounds
LEAST = 1e-6  # below every ratio above zero
_NEVER = (1 << 63) - 1  # holder ordinal of a free target


@dataclass(frozen=True)
class Matches:
    unmatched_targets: DataFrame
    summary: DataFrame
    decide: Callable[[], DataFrame]

    @cached_property
    def decisions(self) -> DataFrame:
        """Only these report best scores, which are searched for when they are asked for."""
        return self.decide()


def fuzzy_match(
    source: DataFrame,
    target: DataFrame,
    key: str = "student_id",
    name_columns: Sequence[str] = ("first_name", "last_name"),
    department_column: str = "department",
    threshold: float = 0.86,
    order_by: str = "row_idx",
) -> Matches:
    """Decisions for every source record, unmatched targets and a summary.

    ``order_by`` is a unique ordinal in both tables.  A ``no_match`` record reports its
    best score among the targets that were unused at its turn.
    """
    if not 0.0 <= threshold <= 1.0:
        raise ValueError(f"threshold must be between 0 and 1 (received: {threshold})")
    boost = DEPARTMENT_BOOST if department_column else 0.0
    least = max(threshold, LEAST)  # a score of 0 is no match
    people = cut_lineage(_people(source, key, name_columns, department_column, order_by))
    first = index_by(target, key, order_by)
    places = _people(first, key, name_columns, department_column, order_by)
    kept: list[DataFrame] = []
    sources = people.select(F.col("idx").alias("s"), "key", "nk", "dk")
    targets = cut_lineage(_in_blocks(places.withColumnRenamed("idx", "t"), kept))
    _release(kept)

    held = cut_lineage(_hold_by_key(sources, targets))
    # Equal departments score the boost, so that below it targets need no name either.
    named = F.lit(True) if least <= boost else F.col("nk") != ""
    state = _Assignment(
        sources.where("nk <> ''").select("s", "nk", "dk"), targets.where(named), held, boost
    )
    state.settle(1.0)
    if threshold < 1.0:
        # The lower the level, the more pairs of names have a gram in common by chance.
        if state.free_sources().select("nk").distinct().count() > MANY:
            state.settle((1.0 + least) / 2)
        state.settle(least)

    def decide() -> DataFrame:
        best = state.best_open_scores(targets)
        return _decisions(people, targets, state.held, best, threshold)

    unmatched = targets.join(state.held.select("t"), "t", "left_anti").select(
        F.col("key").alias("target_record_key"),
        F.col("name").alias("target_name"),
        F.col("department").alias("target_department"),
    )
    partner = state.held.join(targets.select("t"), "t").withColumnRenamed("s", "idx")
    matched = people.join(partner, "idx", "left").select(_match_type(F.col("t").isNotNull()))
    summary = _summary(source, target, key, matched, threshold).select(
        "*",
        F.array(*map(F.lit, name_columns)).cast("array<string>").alias("name_columns"),
        F.lit(department_column).alias("department_column"),
    )
    return Matches(unmatched, summary, decide)


def _people(
    df: DataFrame, key: str, names: Sequence[str], department: str, order_by: str
) -> DataFrame:
    """Ordinal, key, shown name and department, and their compared forms."""
    shown = join_name([F.col(quoted(c)) for c in names])
    team = norm(F.col(quoted(department))) if department else F.lit("")
    return df.select(
        F.col(quoted(order_by)).cast("bigint").alias("idx"),
        norm(F.col(quoted(key))).alias("key"),
        shown.alias("name"),
        team.alias("department"),
        name_key(shown).alias("nk"),
        F.lower(team).alias("dk"),
    )


def running(
    df: DataFrame, group: Sequence[str], order: str, kept: list[DataFrame], **columns: Column
) -> DataFrame:
    """Add the running total of each column over each group; of columns named ``max_...``
    the running maximum.

    A group is cut into ranges of ``RANGE`` values of the order column, which is unique in
    it; each range is aggregated apart and merged with the aggregate of the ranges before
    it, so a group of any size spreads over tasks.  The rows are read twice, so they are
    written; the caller releases what it finds in ``kept``.
    """

    def highest(name: str) -> bool:
        return name.startswith("max_")

    def aggregate(name: str, column: str) -> Column:
        return F.max(column) if highest(name) else F.sum(column)

    marked = df.withColumns({name: c.cast("bigint") for name, c in columns.items()})
    cut = cut_lineage(marked.withColumn("__range", F.floor(F.col(order) / RANGE)))
    kept.append(cut)
    ranges = cut.groupBy(*group, "__range").agg(
        *[aggregate(name, name).alias(f"__{name}") for name in columns]
    )
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = ranges.withColumns(
        {
            f"__{name}": F.coalesce(
                aggregate(name, f"__{name}").over(before), F.lit(-_NEVER if highest(name) else 0)
            )
            for name in columns
        }
    )
    inside = Window.partitionBy(*group, "__range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    merged = {
        name: F.greatest(name, f"__{name}") if highest(name) else F.col(name) + F.col(f"__{name}")
        for name in columns
    }
    return (
        cut.withColumns({name: aggregate(name, name).over(inside) for name in columns})
        .join(shifts, [*group, "__range"])
        .withColumns(merged)
        .drop("__range", *[f"__{name}" for name in columns])
    )


def _release(kept: list[DataFrame]) -> None:
    for df in kept:
        df.unpersist()
        dropped(df)


def _in_blocks(targets: DataFrame, kept: list[DataFrame]) -> DataFrame:
    """Add the block number of each target within its name and department."""
    ranked = running(targets, ["nk", "dk"], "t", kept, rank=F.lit(1))
    return ranked.withColumn("block", F.floor((F.col("rank") - 1) / BLOCK)).drop("rank")


def _hold_by_key(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target is first held by the earliest source with its key.

    A source wants the target with its own key above all others.
    """
    earliest = sources.where("key <> ''").groupBy("key").agg(F.min("s").alias("s"))
    return targets.join(earliest, "key").select(
        "t", "s", F.lit(1.0).alias("score"), F.lit(True).alias("by_key")
    )


class _Assignment:
    """The targets held so far and the rounds that change them.

    Candidates are searched from high scores to low: most records are settled at
    the top, where the search is cheapest, and only the rest is looked up below.
    """

    def __init__(self, sources: DataFrame, targets: DataFrame, held: DataFrame, boost: float):
        self.sources = sources
        self.targets = targets
        self.held = held
        self.boost = boost
        self.target_names = targets.select("nk", "dk").distinct()

    def free_sources(self) -> DataFrame:
        return self.sources.join(self.held.select("s"), "s", "left_anti")

    def settle(self, level: float) -> None:
        """Run rounds until no free source can get a target scoring ``level``."""
        names = self.free_sources().select("nk", "dk").distinct()
        if level >= 1.0:
            # All departments of these names: their holders may be displaced.
            names = self.sources.join(names.select("nk").distinct(), "nk", "left_semi")
            names = names.select("nk", "dk").distinct()
        names = cut_lineage(names)
        members, edges = self.search(names, level)
        if level >= 1.0:
            self.settle_alike(members)

        def searched(wanted: DataFrame) -> None:
            """Search the names among ``wanted`` that were not searched yet."""
            nonlocal names, members, edges
            late = cut_lineage(wanted.join(names, ["nk", "dk"], "left_anti"))
            if not late.isEmpty():
                more_members, more_edges = self.search(late, level)
                members = cut_lineage(members.unionByName(more_members), members)
                edges = cut_lineage(edges.unionByName(more_edges), edges)
                names = cut_lineage(names.unionByName(late), names)

        while True:
            waiting = self.free_sources()
            displaced, again = self.propose(waiting, members, edges, level)
            if not again:
                return
            if displaced:
                # Displaced sources may have names that were not searched yet.
                searched(self.free_sources().select("nk", "dk").distinct())

    def settle_alike(self, members: DataFrame) -> None:
        """Settle names whose sources rank all targets of the name alike at once.

        Let the targets of such a name be t1, t2, ..., some held by the owner of
        their key, and let f be the free sources.  Serving in order means that
        target i takes the earliest of the sources that wait, its own owner
        included, so the first i targets get the i earliest of f and of the owners
        of t1..ti.  Hence source x gets the first target up to which as many are
        free or owned later than x as there are members of f up to x.  Where
        owners come in target order, that target has a closed form in ranks, and a
        chain in which every source displaces the next takes no rounds.

        Names with other holders or other orders are left to the rounds.
        """
        alike = members.groupBy("nk").agg(F.bool_and(F.col("g") == ANY).alias("alike"))
        pure = alike.where("alike").select("nk")
        held = self.held.select("t", F.col("s").alias("owner"))
        owners = self.sources.select(F.col("s").alias("owner"), F.col("nk").alias("owner_nk"))
        owned = F.col("owner").isNotNull()
        kept: list[DataFrame] = []
        targets = running(
            self.targets.select("t", "nk").join(pure, "nk", "left_semi")
            .join(held, "t", "left").join(owners, "owner", "left"),
            ["nk"], "t", kept,
            pos=F.lit(1), taken=F.when(owned, 1).otherwise(0),
        ).persist()
        # Sources that hold a target of another name do not take part.
        mine = targets.where(owned).select(F.col("owner").alias("s"), F.lit(True).alias("mine"))
        waiting = self.free_sources().select("s", F.lit(True).alias("waiting"))
        own = F.when(F.col("mine"), 1).otherwise(0)
        people = running(
            self.sources.select("s", "nk").join(pure, "nk", "left_semi")
            .join(waiting, "s", "left").join(mine, "s", "left")
            .where("waiting or mine"),
            ["nk"], "s", kept,
            wait_rank=F.when(F.col("waiting"), 1).otherwise(0), own_rank=own,
        )
        seats = targets.where(owned).select(
            F.col("owner").alias("s"), F.col("t").alias("own_t"), "taken",
            (F.col("pos") - F.col("taken")).alias("free_before"),
        )
        people = people.join(seats, "s", "left").persist()
        simple = targets.select("nk").distinct().join(
            targets.where(owned).groupBy("nk").agg(F.count_if(
                F.col("owner_nk").isNull() | (F.col("owner_nk") != F.col("nk"))
            ).alias("foreign")), "nk", "left",
        ).join(
            people.where("mine").groupBy("nk").agg(
                F.count_if(F.col("taken") != F.col("own_rank")).alias("unordered")
            ), "nk", "left",
        ).where("coalesce(foreign, 0) = 0 and coalesce(unordered, 0) = 0").select("nk")
        people = people.join(simple, "nk", "left_semi")

        stay = F.col("mine") & (F.col("free_before") >= F.col("wait_rank"))
        stays = people.where(stay).select(F.col("own_t").alias("t"), "s", F.lit(True).alias("by_key"))
        free_seats = targets.where(~owned).select(
            "nk", (F.col("pos") - F.col("taken")).alias("wait_rank"), F.col("pos").alias("free_pos")
        )
        shifted = F.col("wait_rank") + F.col("own_rank")
        moves = (
            people.where(~F.coalesce(stay, F.lit(False)))
            .join(free_seats, ["nk", "wait_rank"], "left")
            .withColumn("pos", F.least(shifted, F.coalesce("free_pos", shifted)))
            .join(targets.select("nk", "pos", "t"), ["nk", "pos"])
            .select("t", "s", F.lit(False).alias("by_key"))
        )
        rest = self.held.join(
            targets.join(simple, "nk", "left_semi").select("t"), "t", "left_anti"
        )
        new = stays.unionByName(moves).select("t", "s", F.lit(1.0).alias("score"), "by_key")
        self.held = cut_lineage(rest.unionByName(new), self.held)
        _release([targets, people, *kept])

    def search(self, names: DataFrame, level: float) -> tuple[DataFrame, DataFrame]:
        """Proposer groups of the names and the edges of each group.

        Sources whose only target name is their own rank all targets of that name
        alike, whatever the department: they propose as one group.
        """
        edges = cut_lineage(self.edges(names, level))
        own_only = F.bool_and((F.col("tnk") == F.col("nk")) & (F.col("ratio") == 1.0))
        members = cut_lineage(
            edges.groupBy("nk", "dk")
            .agg(own_only.alias("alike"))
            .select("nk", "dk", F.when(F.col("alike"), F.lit(ANY)).otherwise(F.col("dk")).alias("g"))
        )
        grouped = edges.join(members, ["nk", "dk"]).select("nk", "g", "tnk", "ratio", "only_dk")
        return members, cut_lineage(grouped.distinct())

    def edges(self, names: DataFrame, level: float) -> DataFrame:
        """Target names whose score can reach ``level`` for each source name group.

        ``only_dk`` is set on edges that need the boost of equal departments.
        """
        wanted = names.select("nk").distinct()
        offered = self.target_names.select(F.col("nk").alias("tnk")).distinct()
        if level >= 1.0:
            plain = wanted.join(offered, F.col("nk") == F.col("tnk"), "left_semi").select(
                "nk", F.col("nk").alias("tnk"), F.lit(1.0).alias("ratio")
            )
        else:
            plain = similar_names(wanted, offered, level)
        groups = names.join(plain, "nk").select(
            "nk", "dk", "tnk", "ratio", F.lit(None).cast("string").alias("only_dk")
        )
        if not self.boost:
            return groups
        teams = names.where("dk <> ''")
        theirs = self.target_names.where("dk <> ''").select(F.col("nk").alias("tnk"), "dk")
        if level > self.boost:
            boosted = similar_names(teams, theirs, level - self.boost, within="dk")
        else:
            # Every target of an equal department is a candidate, whatever its name.
            alike = teams.join(theirs, "dk")
            boosted = alike.withColumn("ratio", ratio(F.col("nk"), F.col("tnk")))
        boosted = boosted.where(F.col("ratio") < level)
        return groups.unionByName(
            boosted.select("nk", "dk", "tnk", "ratio", F.col("dk").alias("only_dk"))
        )

    def score(self, department: str) -> Column:
        """Score of an edge from ``department`` to targets of department ``tdk``."""
        if not self.boost:
            return F.col("ratio")
        same = (F.col(department) != "") & (F.col(department) == F.col("tdk"))
        lifted = F.least(F.lit(1.0), F.col("ratio") + F.lit(self.boost))
        return F.when(same, lifted).otherwise(F.col("ratio"))

    def open_targets(self) -> DataFrame:
        """Targets with the ordinal of their holder."""
        return (
            self.targets.select("t", F.col("nk").alias("tnk"), F.col("dk").alias("tdk"), "block")
            .join(self.held.select("t", F.col("s").alias("holder")), "t", "left")
            .withColumn("holder", F.coalesce("holder", F.lit(_NEVER)))
        )

    def listed(
        self, waiting: DataFrame, edges: DataFrame, level: float, kept: list[DataFrame]
    ) -> DataFrame:
        """The targets each group of waiting sources can reach with its best score."""
        group = ["nk", "g"]
        groups = (
            waiting.groupBy(*group)
            .agg(
                F.count(F.lit(1)).alias("k"),
                F.min("s").alias("first_s"),
                F.max("s").alias("last_s"),
            )
            .join(edges, group)
            .persist()
        )
        targets = self.open_targets().join(groups.select("tnk"), "tnk", "left_semi").persist()
        kept += [groups, targets]
        reachable = self.reachable_blocks(groups, targets, level)
        found = reachable.join(targets, ["tnk", "tdk", "block"]).where(
            F.col("holder") > F.col("first_s")
        )
        return found.select(*group, "k", "t", "score", "holder")

    def propose(
        self, waiting: DataFrame, members: DataFrame, edges: DataFrame, level: float
    ) -> tuple[int, bool]:
        """One round: the number of displaced holders, and whether another round can
        change anything.  It cannot once every source of a group that was offered
        a target got one and nobody was displaced."""
        waiting = waiting.join(members, ["nk", "dk"]).select("s", "nk", "g").persist()
        kept = [waiting]
        bids = self.bids(waiting, self.listed(waiting, edges, level, kept), ["nk", "g"], kept)
        # k of every group with an offer, counted once, travels with its first bid.
        hoped = F.when(F.col("rank") == 1, F.col("k"))
        outcome = (
            bids.groupBy("t")
            .agg(
                F.min_by(F.struct("s", "score"), "s").alias("bid"),
                F.min("holder").alias("holder"),
                F.sum(hoped).alias("hoped"),
            )
            .persist()
        )
        won = F.col("bid.s") < F.col("holder")
        counts = outcome.agg(
            F.count_if(won).alias("accepted"),
            F.count_if(won & (F.col("holder") < F.lit(_NEVER))).alias("displaced"),
            F.coalesce(F.sum("hoped"), F.lit(0)).alias("hoped"),
        ).first()
        if counts.accepted:
            # An outer join keeps the partitioning by target; a union would add to it
            # in every round.
            new = outcome.where(won).select("t", "bid")
            self.held = cut_lineage(
                self.held.join(new, "t", "full_outer").select(
                    "t",
                    F.coalesce("bid.s", "s").alias("s"),
                    F.coalesce("bid.score", "score").alias("score"),
                    (F.col("bid").isNull() & F.col("by_key")).alias("by_key"),
                ),
                self.held,
            )
        _release([outcome, *kept])
        return counts.displaced, counts.displaced > 0 or counts.accepted < counts.hoped

    def bids(
        self,
        waiting: DataFrame,
        listed: DataFrame,
        group: list[str],
        kept: list[DataFrame],
    ) -> DataFrame:
        """The target each waiting source proposes to.

        Let ``first`` be the first place on the group's list whose holder comes
        after the source.  Source j takes the first place that is neither before
        its ``first`` nor taken by sources 1..j-1 of the group: ``j`` plus the
        running maximum of ``first - j``.  No place it could get is passed over.
        """
        offers = running(listed, group, "t", kept, place=F.lit(1), max_reach=F.col("holder"))
        # ``reach`` never falls along the list; places with the same reach count as one row,
        # so all that follow a free target do not meet in one task.
        steps = offers.groupBy(*group, F.col("max_reach").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        none = F.lit(None).cast("bigint").alias("s")
        ranked = running(
            steps.where(F.col("v") < _NEVER).select(*group, "v", "n", none).unionByName(
                waiting.select(*group, F.col("s").alias("v"), F.lit(0).cast("bigint").alias("n"), "s")
            ),
            group, "v", kept, passed=F.col("n"), rank=F.when(F.col("s").isNull(), 0).otherwise(1),
        ).where("s is not null")
        ahead = running(ranked.drop("v", "n"), group, "s", kept, max_ahead=F.col("passed") + 1 - F.col("rank"))
        placed = ahead.withColumn("place", F.col("rank") + F.col("max_ahead"))
        return placed.join(offers.drop("max_reach"), [*group, "place"])

    def block_states(self, targets: DataFrame) -> DataFrame:
        return targets.groupBy("tnk", "tdk", "block").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("holder") == _NEVER).alias("n_free"),
            F.min("holder").alias("low_holder"),
            F.max("holder").alias("high_holder"),
        )

    def reachable_blocks(self, groups: DataFrame, targets: DataFrame, level: float) -> DataFrame:
        """Blocks with the best score a group can get, as many as it needs.

        A block counts in full once all its holders come after the group's last
        source, else with its free targets.  After ``k`` targets so counted every
        source of the group has found one.
        """
        best = Window.partitionBy("nk", "g")
        before = Window.partitionBy("nk", "g", "tnk", "tdk").orderBy("block").rowsBetween(
            Window.unboundedPreceding, -1
        )
        sure = F.when(F.col("low_holder") > F.col("last_s"), F.col("n")).otherwise(
            F.col("n_free")
        )
        return (
            groups.join(self.block_states(targets), "tnk")
            .where(F.col("only_dk").isNull() | (F.col("only_dk") == F.col("tdk")))
            .where(F.col("high_holder") > F.col("first_s"))
            .withColumn("score", self.score("g"))
            .where(F.col("score") >= level)
            .withColumn("top", F.max("score").over(best))
            .where(F.col("score") == F.col("top"))
            .withColumn("passed", F.coalesce(F.sum(sure).over(before), F.lit(0)))
            .where(F.col("passed") < F.col("k"))
            .select("nk", "g", "k", "first_s", "tnk", "tdk", "block", "score")
        )

    def best_open_scores(self, targets: DataFrame) -> DataFrame:
        """Best score of each unmatched source over the ``targets`` that were still
        unused at its turn: those that are free or held by a later source."""
        free = cut_lineage(self.free_sources())
        asked = free.groupBy("nk", "dk").agg(F.min("s").alias("first_s"), F.max("s").alias("last_s"))
        offered = self.open_targets().where("tnk <> ''").groupBy("tnk", "tdk").agg(F.max("holder").alias("until"))
        steps = best_offers(cut_lineage(asked), cut_lineage(offered), self.boost)
        scores = free.join(steps, ["nk", "dk"]).where(F.col("until") > F.col("s")).select("s", "score")
        if self.boost:
            # Equal departments alone score the boost, also without a name.
            holders = targets.where("dk <> ''").join(
                self.held.select("t", F.col("s").alias("holder")), "t", "left"
            )
            last = holders.groupBy("dk").agg(
                F.max(F.coalesce("holder", F.lit(_NEVER))).alias("last")
            )
            scores = scores.unionByName(
                free.join(last, "dk")
                .where(F.col("last") > F.col("s"))
                .select("s", F.lit(self.boost).alias("score"))
            )
        return scores.groupBy("s").agg(F.max("score").alias("best"))


def similar_names(
    wanted: DataFrame, offered: DataFrame, at_least: float, within: str | None = None
) -> DataFrame:
    """All pairs (``nk``, ``tnk``) of distinct names with a ratio of ``at_least``.

    Names are indexed by their rarest q-grams only, as many as the ratio requires
    (a prefix filter): no qualifying pair is lost, and a gram that most names
    share is in no index.  Frequent grams of the offered names, at most ``FREQUENT``, are told
    to all tasks.  ``within`` restricts the pairs to equal values of a column of both tables.
    """
    extra = [within] if within else []
    salt = F.xxhash64(within) if within else F.lit(0).cast("bigint")
    every = offered.where(F.length("tnk") > 0).select(
        F.explode(gram_column(F.col("tnk"), salt, at_least)).alias("token")
    )
    counted = cut_lineage(every.groupBy("token").agg(F.count(F.lit(1)).alias("seen")))
    total = counted.agg(F.sum("seen")).first()[0] or 0
    often = counted.where(F.col("seen") > max(SELDOM, total // FREQUENT)).toArrow().sort_by("token")
    dropped(counted)
    common = often["token"].to_numpy(), often["seen"].to_numpy()

    def indexed(df: DataFrame, name: str, length: str) -> DataFrame:
        return df.where(F.length(name) > 0).select(
            name, F.length(name).alias(length), *extra,
            F.explode(gram_column(F.col(name), salt, at_least, common)).alias("token"),
        )

    # Sizes are estimated from the names, of which each becomes many grams; a side that seems
    # short would pass through the driver with all of them.
    left, right = indexed(wanted, "nk", "len").hint("merge"), indexed(offered, "tnk", "tlen")
    shorter, longer = F.least("len", "tlen"), F.greatest("len", "tlen")
    pairs = (
        left.join(right, ["token", *extra])
        .where(2 * shorter >= (at_least - 1e-9) * (shorter + longer))
        .select("nk", "tnk", *extra)
        .distinct()
    )
    return pairs.withColumn("ratio", ratio(F.col("nk"), F.col("tnk"), at_least)).where(
        F.col("ratio") >= at_least
    )


def _match_type(found: Column) -> Column:
    kind = F.when(~found, "no_match").when(F.col("by_key"), "exact_key").otherwise("fuzzy_name")
    return kind.alias("match_type")


def _decisions(
    people: DataFrame,
    targets: DataFrame,
    held: DataFrame,
    best: DataFrame,
    threshold: float,
) -> DataFrame:
    """One row per source record with the match, its score and the reason."""
    partner = held.join(
        targets.select(
            "t",
            F.col("key").alias("target_record_key"),
            F.col("name").alias("target_name"),
            F.col("department").alias("target_department"),
        ),
        "t",
    ).withColumnRenamed("s", "idx")
    rows = people.join(partner, "idx", "left")
    rows = rows.join(best.withColumnRenamed("s", "idx"), "idx", "left").withColumn(
        "best", F.coalesce("best", F.lit(0.0))
    )
    found = F.col("t").isNotNull()
    named = F.col("nk") != ""
    shown = F.when(found, F.col("score")).when(named, F.col("best")).otherwise(F.lit(0.0))
    below = F.concat(
        F.lit("Best candidate score "), fmt3(F.col("best")), F.lit(f" below threshold {threshold:.2f}")
    )
    why = F.when(named, below).otherwise(F.lit("No usable source name fields for fuzzy match"))
    prefix = F.concat(F.lit("Source key '"), F.col("key"), F.lit("' not present in target and "))
    no_match = F.when(F.col("key") != "", F.concat(prefix, F.lower(why))).otherwise(why)
    blank = F.lit("")
    return rows.select(
        F.col("idx").alias("row_idx"),
        F.col("key").alias("source_record_key"),
        F.col("name").alias("source_name"),
        F.col("department").alias("source_department"),
        *[
            F.coalesce(c, blank).alias(c)
            for c in ("target_record_key", "target_name", "target_department")
        ],
        _match_type(found),
        fmt3(shown).alias("match_score"),
        F.when(~found, no_match)
        .when(F.col("by_key"), "Key match")
        .otherwise("Name similarity match")
        .alias("reason"),
    )


def _summary(
    source: DataFrame, target: DataFrame, key: str, matched: DataFrame, threshold: float
) -> DataFrame:
    kinds = ("exact_key", "fuzzy_name", "no_match")
    counts = matched.agg(
        F.count(F.lit(1)).alias("source_records"),
        *[F.count_if(F.col("match_type") == k).alias(k) for k in kinds],
    )
    # Two one-row tables.
    return counts.crossJoin(index_counts(target, key, "target_")).select(
        "source_records",
        "target_records",
        F.lit(threshold).alias("threshold"),
        *kinds,
        (
            F.col("target_records")
            - F.col("target_duplicates_ignored")
            - F.col("target_missing_key_rows")
            - F.col("exact_key")
            - F.col("fuzzy_name")
        ).alias("target_unmatched_records"),
        "target_duplicates_ignored",
        "target_missing_key_rows",
    )
