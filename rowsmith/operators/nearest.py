"""The best score each name group can still get, without writing pairs of names.

The names on offer are sorted by department and by the letters they hold, and cut into nodes
of neighbours.  A node is known by a summary: the most its names have of each letter, its
shortest name, its departments and its latest holder.  No name of a node scores more than the
summary allows.  Every asked name is first searched in the node that allows most; what it
finds there rules out all nodes that do not allow more, and only the others are searched.

In a node every pair's score is bounded by the letters both names have, two counts of common
bits a pair, and pairs are compared from the highest bound down.  A running maximum ends the
search: nothing whose bound is not above it is compared.  Only steps of the maximum leave the
task.

An offer lasts for sources before its holder, so the best score of a group falls with the
ordinal of the source.  The groups' answer is that staircase: scores, and the ordinal below
which each is to be had.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..functions.similarity import Names, ratios, upper_bound
from ..session import cut_lineage, dropped

# Python workers get this module with the plan, so no executor needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ASKED = 1024  # groups that one task searches for at a time, about
NODE = 2048  # offers in a node at most
NODES = 1 << 14  # summaries that one task holds, about
_ROWS, _TOP, _SLICE = 256, 16, 1 << 13


class _Search:
    """Groups against the offers of one node."""

    def __init__(self, asked: pd.DataFrame, offered: pd.DataFrame, boost: float):
        self.boost = boost
        self.group_name, names = pd.factorize(asked["nk"])
        self.offer_name, targets = pd.factorize(offered["tnk"])
        self.names, self.targets = Names(names), Names(targets)
        self.first, self.last = asked["first_s"].to_numpy(), asked["last_s"].to_numpy()
        self.until = offered["until"].to_numpy()
        codes, _ = pd.factorize(pd.concat([asked["dk"], offered["tdk"]]))
        blank = np.concatenate([asked["dk"] == "", offered["tdk"] == ""])
        codes = np.where(blank, -1, codes)
        self.group_team, self.offer_team = codes[: len(asked)], codes[len(asked) :]
        self.best = asked["best"].to_numpy().copy()  # what every source of the group can get
        self.steps: list[tuple[np.ndarray, ...]] = []

    def compare(self, group: np.ndarray, offer: np.ndarray) -> None:
        """Compare pairs of groups and offers, and raise the running maxima."""
        value = ratios(self.names, self.group_name[group], self.targets, self.offer_name[offer])
        if self.boost:
            team = self.group_team[group]
            same = (team >= 0) & (team == self.offer_team[offer])
            value = np.where(same, np.minimum(1.0, value + self.boost), value)
        until = self.until[offer]
        of_use = (value > self.best[group]) & (until > self.first[group])
        group, value, until = group[of_use], value[of_use], until[of_use]
        self.steps.append((group, value, until))
        lasting = until > self.last[group]
        np.maximum.at(self.best, group[lasting], value[lasting])

    def run(self) -> pd.DataFrame:
        offers = np.arange(len(self.until))
        for low in range(0, len(self.first), _ROWS):
            groups = np.arange(low, min(low + _ROWS, len(self.first)))
            group, offer = np.repeat(groups, len(offers)), np.tile(offers, len(groups))
            bound = upper_bound(
                self.names, self.group_name[group], self.targets, self.offer_name[offer]
            ).reshape(len(groups), -1)
            if self.boost:
                team = self.group_team[groups][:, None]
                bound = bound + self.boost * ((team >= 0) & (team == self.offer_team))
            bound[self.until <= self.first[groups][:, None]] = 0.0
            top = np.argpartition(-bound, min(_TOP, len(offers)) - 1, axis=1)[:, :_TOP]
            row, column = np.repeat(np.arange(len(groups)), top.shape[1]), top.ravel()
            self._above(groups, bound, row, column)
            bound[row, column] = 0.0
            row, column = np.nonzero(bound > self.best[groups][:, None])
            order = np.argsort(-bound[row, column], kind="stable")
            row, column = row[order], column[order]
            for at in range(0, len(row), _SLICE):
                self._above(groups, bound, row[at : at + _SLICE], column[at : at + _SLICE])
        return self._staircases()

    def _above(self, groups, bound, row, column) -> None:
        """Compare those of the pairs whose bound is above the running maximum."""
        hopeful = bound[row, column] > self.best[groups[row]]
        if hopeful.any():
            self.compare(groups[row[hopeful]], column[hopeful])

    def _staircases(self) -> pd.DataFrame:
        group, score, until = (
            np.concatenate(part) if self.steps else np.zeros(0) for part in zip(*self.steps)
        ) if self.steps else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        found = pd.DataFrame({"group": group, "score": score, "until": until})
        found = found.sort_values(["group", "score", "until"], ascending=[True, False, False])
        # A score counts only if it lasts longer than all higher ones.
        before = found.groupby("group")["until"].cummax().groupby(found["group"]).shift(fill_value=-1)
        return found[found["until"] > before]


_GROUPS = "nk string, dk string, first_s long, last_s long, best double"


def _searched(boost: float, schema: pa.Schema):
    def run(asked: pa.Table, offered: pa.Table) -> pa.Table:
        if not len(asked) or not len(offered):
            return schema.empty_table()
        groups = asked.to_pandas()
        found = _Search(groups, offered.to_pandas(), boost).run()
        at = found["group"].to_numpy().astype(np.int64)
        return pa.table(
            [groups["nk"].to_numpy()[at], groups["dk"].to_numpy()[at], found["score"].to_numpy(),
             found["until"].to_numpy().astype(np.int64)], schema=schema,
        )

    return run


def _letters(names: pd.Series) -> pd.Series:
    """A bit for each class of letters that a name holds."""
    held = Names(names).counts > 0
    return pd.Series((held * (np.int64(1) << np.arange(held.shape[1]))).sum(axis=1))


def _numbered(size: int):
    def run(batches):
        node = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, len(batch), size):
                yield batch.iloc[low : low + size].assign(node=node)
                node += 1

    return run


def _in_nodes(offered: DataFrame) -> DataFrame:
    """The offers with the number of their node."""
    letters = F.pandas_udf(_letters, "long")
    near = offered.withColumn("letters", letters("tnk"))
    by = ["tdk", "letters", "tnk"]
    near = near.repartitionByRange(*by).sortWithinPartitions(*by).drop("letters")
    return near.mapInPandas(_numbered(NODE), "tnk string, tdk string, until long, node long")


def _summary(offered: pd.DataFrame) -> pd.DataFrame:
    names = Names(offered["tnk"])
    return pd.DataFrame({
        "node": offered["node"].iloc[:1], "most": [names.counts.max(axis=0).tobytes()],
        "shortest": [names.length.min()], "latest": [offered["until"].max()],
        "low_dk": [offered["tdk"].min()], "high_dk": [offered["tdk"].max()],
    })


def _allowed(groups: pd.DataFrame, nodes: pd.DataFrame, boost: float) -> np.ndarray:
    """The highest score each node's summary allows each group; 0 where its offers have ended."""
    names = Names(groups["nk"])
    most = np.frombuffer(b"".join(nodes["most"]), np.uint16).reshape(len(nodes), -1)
    common = np.zeros((len(groups), len(nodes)), dtype=np.int64)
    for letter in np.flatnonzero(names.counts.any(axis=0)):
        common += np.minimum(names.counts[:, letter, None], most[None, :, letter])
    # Counts end at 65,535; a group with more letters of a kind is ruled out by no node.
    common[(names.counts == 0xFFFF).any(axis=1)] = 1 << 40
    bound = 2.0 * common / (names.length[:, None] + nodes["shortest"].to_numpy())
    if boost:
        team = groups["dk"].to_numpy(dtype=str)[:, None]
        low, high = (nodes[c].to_numpy(dtype=str) for c in ("low_dk", "high_dk"))
        bound = bound + boost * ((team != "") & (low <= team) & (team <= high))
    bound[nodes["latest"].to_numpy() <= groups["first_s"].to_numpy()[:, None]] = 0.0
    return bound


def _chosen(boost: float, first: bool, schema: pa.Schema):
    """The node that allows a group most, or all that allow more than its best score."""

    def run(asked: pa.Table, summaries: pa.Table) -> pa.Table:
        if not len(asked) or not len(summaries):
            return schema.empty_table()
        groups, nodes = asked.to_pandas(), summaries.to_pandas().sort_values("latest", ascending=False)
        found = []
        for low in range(0, len(groups), _ROWS):
            part = groups.iloc[low : low + _ROWS]
            bound = _allowed(part, nodes, boost)
            fit = bound > part["best"].to_numpy()[:, None]
            if first:
                fit &= np.arange(len(nodes)) == bound.argmax(axis=1)[:, None]
            row, column = np.nonzero(fit)
            found.append(part.iloc[row].assign(node=nodes["node"].to_numpy()[column]))
        return pa.Table.from_pandas(
            pd.concat(found)[schema.names], schema=schema, preserve_index=False
        )

    return run


def best_offers(asked: DataFrame, offered: DataFrame, boost: float) -> DataFrame:
    """(nk, dk, score, until) of the steps of every group's best score above 0.

    ``asked`` has groups (nk, dk, first_s, last_s) of sources with one name and department and
    their first and last ordinal; ``offered`` has (tnk, tdk, until), names with the ordinal of
    the latest holder.  Names are not blank.  A source s of a group can get the highest score
    whose ``until`` is above s.
    """
    spark = asked.sparkSession
    members = cut_lineage(_in_nodes(offered.select("tnk", "tdk", "until")))
    summaries = cut_lineage(members.groupBy("node").applyInPandas(
        _summary, "node long, most binary, shortest long, latest long, low_dk string, high_dk string"
    ))
    n_asked, n_nodes = asked.count(), summaries.count()
    parts = max(1, -(-n_asked // ASKED))
    cells = max(parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_asked // 32))
    blocks = max(1, -(-n_nodes // NODES))

    def dealt(df: DataFrame, own: str, size: int, names: list[str], other: str, others: int):
        mine = F.pmod(F.xxhash64(*names), F.lit(size)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn(own, mine).withColumn(other, every)

    def search(groups: DataFrame, first: bool) -> DataFrame:
        one = dealt(groups, "a", cells, ["nk", "dk"], "o", blocks)
        two = dealt(summaries, "o", blocks, ["node"], "a", cells)
        schema = pa.schema(
            [("nk", pa.string()), ("dk", pa.string()), ("first_s", pa.int64()),
             ("last_s", pa.int64()), ("best", pa.float64()), ("node", pa.int64())]
        )
        chosen = one.groupBy("a", "o").cogroup(two.groupBy("a", "o")).applyInArrow(
            _chosen(boost, first, schema), f"{_GROUPS}, node long"
        )
        # So many groups may choose one node that they are searched for in parts.
        part = F.pmod(F.xxhash64("nk", "dk"), F.lit(parts)).cast("int")
        chosen = cut_lineage(chosen.withColumn("part", part))
        asking = chosen.select("node", F.col("part").alias("share")).distinct()
        schema = pa.schema(
            [("nk", pa.string()), ("dk", pa.string()), ("score", pa.float64()), ("until", pa.int64())]
        )
        steps = chosen.groupBy("node", "part").cogroup(
            members.join(asking, "node").groupBy("node", "share")
        ).applyInArrow(_searched(boost, schema), "nk string, dk string, score double, until long")
        steps = cut_lineage(steps)
        dropped(chosen)
        return steps

    begun = search(asked.withColumn("best", F.lit(0.0)).select("nk", "dk", "first_s", "last_s", "best"), True)
    lasting = (
        begun.join(asked, ["nk", "dk"]).where(F.col("until") > F.col("last_s"))
        .groupBy("nk", "dk").agg(F.max("score").alias("best"))
    )
    groups = asked.join(lasting, ["nk", "dk"], "left").select(
        "nk", "dk", "first_s", "last_s", F.coalesce("best", F.lit(0.0)).alias("best")
    )
    ended = search(groups, False)
    dropped(members)
    dropped(summaries)
    return begun.unionByName(ended)
