"""A Merkle manifest of a dataset: a tree per source, a tree over the sources, proofs for all.

Leaves are ranked within their source, and the digits of the rank (base 16) say where a leaf
sits. Inside blocks of 4,096 leaves the digits are grouped away one after another, each
group nesting its children as structs; the hashes of the blocks are the leaves of the next,
4,096 times smaller rollup, up to one node. On the way back down a last grouping lays the
path above a block beside its nested nodes, and transforms and explodes of 16 children at a
time write the proofs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.session import materialize

BITS = 4
#: Nodes in a run, and digits (two at least) of the rank inside a block: 16**3 leaves.
ARITY = 1 << BITS
DIGITS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = ARITY**DIGITS
PROOF = "array<struct<left:string,right:string>>"


def digest(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of texts, one after another."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the length of the value's text in bytes, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    return digest(*[encoded(c) for c in columns.values()])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give, level by level."""
    return F.aggregate(proof, leaf, lambda h, level: digest(level["left"], h, level["right"]))


def _ordered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with rank (from 0, by ``order``) and n (rows) within each group; nulls first.

    Rows are dealt into ranges of (group, order, a number of the row), so a group that holds
    most rows is spread, and so is one value that many rows share. A row's place is its
    place in its range and the sum of the ranges before, one row per range and group.
    """
    keys = [*group, *order]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys, "_row")
    placed = dealt.sortWithinPartitions(*keys, "_row").withColumn("_at", F.monotonically_increasing_id())
    # The upper bits number the partition, the lower 33 the row in it.
    placed = materialize(
        placed.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("_row")
    )
    sizes = placed.groupBy("_range", *group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = own.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("_range").alias("_of"), *[F.col(g).alias(f"_of_{g}") for g in group],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(own).alias("n"),
    )
    same = reduce(
        Column.__and__, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group], F.col("_range") == F.col("_of")
    )
    return (
        placed.join(sizes, same).withColumn("rank", F.col("_at") + F.col("_shift"))
        .drop("_range", "_at", "_shift", "_of", *[f"_of_{g}" for g in group])
    )


def _grouped_away(nodes: DataFrame, group: Sequence[str], digit: int, others: Sequence[str]) -> DataFrame:
    """Runs of 16 nodes become their parent, which nests them as ``kids``.

    Where the group has one node at this level already, it is its parent's hash.
    """
    number = F.col("rank") % ARITY
    kids = F.array_sort(F.collect_list(F.struct(number.alias("digit"), "hash", *others)))
    hashes = F.concat_ws("", F.transform("kids", lambda k: k["hash"]))
    alone = F.col("n") <= ARITY**digit
    return (
        nodes.groupBy(*group, F.shiftright("rank", BITS).alias("rank")).agg(F.first("n").alias("n"), kids.alias("kids"))
        .withColumn("hash", F.when(alone, F.col("kids")[0]["hash"]).otherwise(digest(hashes)))
    )


def _levels(nodes: DataFrame, group: Sequence[str], payload: Sequence[str]) -> list[DataFrame]:
    """Nested blocks of every rollup, from the leaves up to one block per group.

    ``nodes``: the group, rank, n, hash and ``payload``. All digits of a block but the last
    are grouped away in each result; the last is on the way down, with the path above.
    """
    out = []
    while True:
        # One shuffle a rollup: all its groupings keep a block's rows together.
        block = F.shiftright("rank", BITS * DIGITS).alias("block")
        rows = nodes.select(*group, block, "rank", "n", "hash", *payload).repartition(*group, "block")
        for digit in range(DIGITS - 1):
            rows = _grouped_away(rows, [*group, "block"], digit, ["kids"] if digit else payload)
        rows = materialize(rows)
        out.append(rows)
        most = rows.agg(F.max("n")).first()[0]
        if most is None or most <= BLOCK:
            return out
        top = _grouped_away(rows.drop("kids"), [*group, "block"], DIGITS - 1, [])
        nodes = top.select(
            *group, F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), "hash"
        )
        payload = []


def _roots(top: DataFrame, group: Sequence[str]) -> DataFrame:
    """The group and hash of trees that are one block."""
    return _grouped_away(top.drop("kids"), [*group, "block"], DIGITS - 1, []).select(*group, "hash")


def _with_proofs(
    levels: list[DataFrame], group: Sequence[str], above: DataFrame, payload: Sequence[str]
) -> DataFrame:
    """``payload``, group, hash, proof and the other columns of ``above`` for each leaf.

    ``above``: one row per group with the proof of the group's root, and what else is to be
    handed to its leaves. A proof is a list of (left, right): the hashes of the siblings
    before and after the node, from the leaf up.
    """
    handed = [c for c in above.columns if c not in (*group, "proof")]
    path = above.select(*group, F.lit(0).cast("long").alias("block"), F.struct("proof", *handed).alias("above"))
    for level in reversed(levels):
        inside = payload if level is levels[0] else []
        node = F.struct((F.col("rank") % ARITY).alias("digit"), "hash", "kids").alias("node")
        nested = level.select(*group, "block", "n", node)
        # A block's last digit and the path above it come together in one grouping.
        blocks = nested.unionByName(path, allowMissingColumns=True).groupBy(*group, "block").agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list("node")).alias("kids"),
            F.first("above", ignorenulls=True).alias("above"),
        )
        rows = blocks.select(
            *group, "n", "kids", "above", F.col("above")["proof"].alias("proof"), F.col("block").alias("rank")
        )
        for digit in reversed(range(DIGITS)):
            rows = _opened(rows, group, digit, ["kids"] if digit else inside)
        rest = [F.col("above")[c].alias(c) for c in handed]
        path = rows.select(*group, F.col("rank").alias("block"), F.struct("proof", *rest).alias("above"))
    return rows.select(*group, *payload, "hash", "proof", *rest)


def _opened(rows: DataFrame, group: Sequence[str], digit: int, others: Sequence[str]) -> DataFrame:
    """A row for each of the at most 16 kids, its siblings put in front of the proof."""
    hashes = F.transform("kids", lambda k: k["hash"])
    joined = lambda at, n: F.concat_ws("", F.slice("_hashes", at, n))
    siblings = F.array(F.struct(
        joined(F.lit(1), F.col("_i")).alias("left"), joined(F.col("_i") + 2, F.lit(ARITY)).alias("right")
    ))
    # A group that has one node at this level gains none above it.
    gained = F.when(F.col("n") <= ARITY**digit, F.col("proof")).otherwise(F.concat(siblings, F.col("proof")))
    one = rows.withColumn("_hashes", hashes).select(
        *group, "n", "above", "rank", "proof", "_hashes", F.posexplode("kids").alias("_i", "_kid")
    )
    return one.select(
        *group, "n", "above", gained.alias("proof"),
        (F.col("rank") * ARITY + F.col("_kid")["digit"]).alias("rank"),
        F.col("_kid")["hash"].alias("hash"), *[F.col("_kid")[c].alias(c) for c in others],
    )


def manifest(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Rows (doc_id, source, leaf, subroot, root, proof, now) for every row of ``docs``.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text, each with its length.
    In a source leaves ascend by doc_id (equal ones by hash; null first); 16 nodes in a run
    become their parent until one is left, the subroot. Sources ascend by name in UTF-8
    bytes, null first, and their subroots give the root the same way. ``proof`` lists the
    siblings (left, right) of a leaf up to the root; :func:`folded` follows it. ``now`` is
    the leaf of the row as it would be with ``text`` in place of its text where ``tampered``
    holds, else the leaf itself.

    Repeated rows are leaves each. A null column counts as null, an empty text does not. An
    empty table gives no rows. Other columns are ignored.

    Texts are read once and hashed where they lie. What is shuffled is the hash and the
    doc_id of a row, in blocks of at most 4,096 leaves; no source has to fit in one task,
    and no proof takes a join.
    """
    plain = {c: F.col(c) for c in COLUMNS}
    changed = F.when(F.coalesce(tampered, F.lit(False)), leaf_hash({**plain, "text": text}))
    leaves = materialize(docs.select("doc_id", "source", leaf_hash(plain).alias("hash"), changed.alias("changed")))
    ranked = _ordered(leaves, ["source"], ["doc_id", "hash"])
    trees = _levels(ranked, ["source"], ["doc_id", "changed"])
    sources = _ordered(_roots(trees[-1], ["source"]), [], ["source"]).withColumn("all", F.lit(0))
    over = _levels(sources, ["all"], ["source"])
    top = _roots(over[-1], ["all"])
    root = top.select("all", F.array().cast(PROOF).alias("proof"), F.col("hash").alias("root"))
    above = _with_proofs(over, ["all"], root, ["source"]).select(
        "source", "proof", F.col("hash").alias("subroot"), "root"
    )
    return _with_proofs(trees, ["source"], above, ["doc_id", "changed"]).select(
        "doc_id", "source", F.col("hash").alias("leaf"), "subroot", "root", "proof",
        F.coalesce("changed", "hash").alias("now"),
    )


def lower_cased(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)
