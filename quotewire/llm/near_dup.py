"""Near-duplicate documents: consistent weighted sampling of TF-IDF shingles, in bands.

A text is its five-word shingles, lower-cased, each weighing its count times its idf.
Nearly every five-word shingle occurs once or as often as its document was copied, so
counting documents by shingle would weigh a group of copies down for being one. Document
frequencies are counted by word instead, over all documents, in a hashed table of fixed
size; a shingle's idf is the mean of its words', between 1 and 2.

Improved consistent weighted sampling (Ioffe, 2010) draws ``BANDS * ROWS`` samples of a
text; two texts agree in a sample with the probability of their weighted Jaccard
similarity. Texts that agree in all samples of a band share its bucket. Pairs found in
buckets are verified on the texts. No bucket is expanded into all its pairs: each text is
first tried against one hub, and what follows looks only at texts that share a bucket and
are not yet in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.llm.graph import components
from quotewire.llm.substring import text_key
from quotewire.llm.words import U64, WordHasher, mix, ranges, set_aside, slices
from quotewire.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Pairs that agree in a smaller share of their samples are not verified. At a similarity
#: of 0.8 the share of 64 samples is below this once in some 10,000 pairs.
LEAST_AGREEMENT = 0.61
#: Samples that texts of mixed buckets are compared by, and the least share of agreement
#: worth a verification: four standard deviations below a similarity of 0.8.
FINE = 512
LEAST_FINE = 0.73
#: First tries per text among those of other classes, before all that are left are tried.
FIRST_TRIES = 6
IDF_BITS = 16
CHUNK = 1024
_TABLE = 1 << 16
_BLOCK = 512  # shingles drawn from at once, so that the cells stay in the processor's cache
_PAIRS = 1 << 15  # pairs compared at once; their fine samples are 512 bytes a side


def _texts(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower("text"))


def word_idf(docs: DataFrame) -> np.ndarray:
    """Idf of every word bucket, 1 to 2, from the documents that hold it.

    The table has 2**16 entries whatever the input; tasks send one count per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sums, n = WordHasher(), np.zeros(1 << IDF_BITS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                rows = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(heads))
                held = np.unique((rows << IDF_BITS) | (words >> U64(64 - IDF_BITS)).astype(np.int64))
                sums += np.bincount(held & ((1 << IDF_BITS) - 1), minlength=len(sums))
                n += int((np.diff(heads) > 0).sum())
        at = np.flatnonzero(sums)
        yield pa.record_batch(
            [pa.array(np.append(at, -1)), pa.array(np.append(sums[at], n))], names=["bucket", "n"]
        )

    counted = (
        _texts(docs).select("text").mapInArrow(count, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    sums = np.zeros((1 << IDF_BITS) + 1)
    sums[counted["bucket"]] = counted["n"]
    n = sums[-1]
    return 1 + np.log((1 + n) / (1 + sums[:-1])) / np.log(2 + n)


def shingles(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of one text in order, their counts and their idf.

    A text of fewer than five words is one shingle; a text without words has none.
    """
    width = min(SHINGLE, len(words))
    if not width:
        return np.empty(0, U64), np.empty(0, np.int64), np.empty(0)
    n = len(words) - width + 1
    own, key, weight = idf[(words >> U64(64 - IDF_BITS)).astype(np.int64)], np.zeros(n, U64), np.zeros(n)
    for i in range(width):
        key = (key ^ words[i : i + n]) * U64(0x9E3779B97F4A7C15)
        key ^= key >> U64(29)
        weight += own[i : i + n]
    key, first, counts = np.unique(mix(key), return_index=True, return_counts=True)
    return key, counts, weight[first] / width


class _Sampler:
    """Draws the samples; the random numbers come from tables that all tasks share."""

    def __init__(self, samples: int):
        rng = np.random.RandomState(20100601)
        gamma = rng.gamma(2.0, size=(2, _TABLE))
        self.r = gamma[0].astype(np.float32)
        self.log_c = np.log(gamma[1]).astype(np.float32)
        self.beta = rng.random_sample(_TABLE).astype(np.float32)
        self.odd = rng.randint(0, 1 << 62, samples).astype(U64) * U64(2) + U64(1)

    def draw(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each sample the number of the chosen shingle and its level, in 64 bits."""
        best = np.full(len(self.odd), np.inf, np.float32)
        out = np.zeros(len(self.odd), U64)
        rows, logs = np.arange(len(self.odd)), np.log(weights).astype(np.float32)
        for at in range(0, len(keys), _BLOCK):
            own = keys[at : at + _BLOCK]
            cell = own[None, :] * self.odd[:, None]
            cell >>= U64(48)
            cell = cell.astype(np.intp)
            r, beta, cost = self.r.take(cell), self.beta.take(cell), self.log_c.take(cell)
            level = logs[at : at + _BLOCK] / r
            level += beta
            np.floor(level, out=level)
            np.subtract(level, beta, out=beta)
            beta += np.float32(1)
            beta *= r
            cost -= beta
            pick = cost.argmin(1)
            least = cost[rows, pick]
            better = least < best
            best = np.where(better, least, best)
            found = mix(own[pick] ^ mix(level[rows, pick].astype(np.int64).view(U64) + self.odd))
            out = np.where(better, found, out)
        return out


def signatures(docs: DataFrame, idf) -> DataFrame:
    """Rows (doc_id, _f1, _f2, keys, sketch): bucket of each band, and 8 bits a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sampler, table = WordHasher(), _Sampler(BANDS * ROWS), idf.value
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                known, keys, sketches = {}, [], []
                for i, text in enumerate(zip(part["_f1"].to_pylist(), part["_f2"].to_pylist())):
                    if heads[i] == heads[i + 1]:
                        known[text] = (None, None)
                    elif text not in known:
                        key, n, weight = shingles(words[heads[i] : heads[i + 1]], table)
                        drawn = sampler.draw(key, n * weight)
                        band = np.arange(BANDS, dtype=U64)
                        for j in range(ROWS):
                            band = mix(band * U64(31) + drawn[j::ROWS])
                        known[text] = (band.view(np.int64), (drawn & U64(255)).astype(np.uint8).tobytes())
                    keys.append(known[text][0])
                    sketches.append(known[text][1])
                yield pa.record_batch(
                    [part["doc_id"], part["_f1"], part["_f2"], pa.array(keys, pa.list_(pa.int64())),
                     pa.array(sketches, pa.binary())],
                    names=["doc_id", "_f1", "_f2", "keys", "sketch"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs).select("doc_id", "_f1", "_f2", "text").mapInArrow(
        run, f"doc_id {kind}, _f1 long, _f2 long, keys array<long>, sketch binary"
    )


def _agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for s in (a, b))
    return (x == y).mean(1)


def _best_hubs(nodes: DataFrame, bands: DataFrame) -> DataFrame:
    """One pair (a, b) per text: the end of one of its buckets that agrees with it most."""
    ends = materialize(
        bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
    )
    tries = (
        bands.join(ends, "key").select("node", F.explode(F.array("low", "high")).alias("hub"))
        .where("node <> hub").distinct()
    )
    sketch = nodes.select("node", "sketch")
    both = tries.join(sketch, "node").join(sketch.toDF("hub", "other"), "hub")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = _agreement(batch["sketch"], batch["other"])
            good = pa.array(share >= LEAST_AGREEMENT)
            out = [batch["node"], batch["hub"], pa.array((share * BANDS * ROWS).astype(np.int64))]
            yield pa.record_batch([c.filter(good) for c in out], names=["node", "hub", "agree"])

    # A node number has under 56 bits, so the best of (agree, hub) is the largest long.
    scored = both.mapInArrow(score, "node long, hub long, agree long")
    code = F.shiftleft("agree", 56) + F.col("hub")
    best = scored.groupBy("node").agg(F.max(code).alias("code"))
    return best.select(F.col("node").alias("a"), F.col("code").bitwiseAND((1 << 56) - 1).alias("b"))


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``by``, cut between groups only."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        same = np.ones(table.num_rows, bool)
        for c in by:
            values = table[c].to_numpy()
            same &= values == values[-1]
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


def _fine_sketches(texts: DataFrame, wanted: DataFrame, idf) -> DataFrame:
    """Rows (node, fine): 8 bits for each of ``FINE`` samples of the wanted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sampler, table = WordHasher(), _Sampler(FINE), idf.value
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                out = []
                for at, to in zip(heads, heads[1:]):
                    key, n, weight = shingles(words[at:to], table)
                    out.append((sampler.draw(key, n * weight) & U64(255)).astype(np.uint8).tobytes())
                yield pa.record_batch([part["node"], pa.array(out, pa.binary())], names=["node", "fine"])

    rows = texts.join(wanted.select("node").distinct(), "node").select("node", "text")
    return materialize(rows.mapInArrow(run, "node long, fine binary"))


def _mixed(bands: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``bands`` with classes, and the buckets of several classes: key, n, outside, main."""
    marked = bands.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    sizes = marked.groupBy("key", "component").agg(F.count("*").alias("size"))
    buckets = sizes.groupBy("key").agg(
        F.sum("size").alias("n"), (F.sum("size") - F.max("size")).alias("outside"),
        F.max(F.struct("size", "component"))["component"].alias("main"), F.count("*").alias("kinds"),
    )
    return marked, materialize(buckets.where("kinds > 1").drop("kinds"))


def _cross_pairs(marked: DataFrame, mixed: DataFrame, held: DataFrame, tries: int | None) -> DataFrame:
    """Pairs (a, b) that share a bucket, lie in different classes and agree enough.

    ``tries`` keeps the best few of each text in each bucket; None gives all. Of a bucket
    only the texts outside its largest class are tried, against all others; larger
    buckets are dealt out in blocks of texts, so no task holds one whole.
    """
    hashed = F.xxhash64("node")

    def blocks(n: str):
        return F.ceil(F.col(n) / CHUNK).cast("int")

    def spots(side: int, n: str, i, j):
        numbers = F.sequence(F.lit(0), blocks(n) - 1)
        return F.transform(numbers, lambda x: F.struct(
            F.lit(side).alias("side"), i(x).alias("i"), j(x).alias("j")
        ))

    def cut(n: str):
        return F.pmod(hashed, blocks(n)).cast("int")

    tried = spots(1, "n", lambda x: cut("outside"), lambda x: x)
    others = spots(0, "outside", lambda x: x, lambda x: cut("n"))
    places = F.when(F.col("component") != F.col("main"), F.concat(tried, others)).otherwise(others)
    by = ["key", "i", "j"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, by):
            new = np.zeros(table.num_rows, bool)
            new[0] = True
            for c in by:
                values = table[c].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            group = np.cumsum(new) - 1
            side, node, component, band = (
                table[c].to_numpy() for c in ("side", "node", "component", "band")
            )
            keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            sketch = np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint8).reshape(-1, FINE)
            ours, theirs = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            first = np.searchsorted(group[theirs], group[ours], side="left")
            count = np.searchsorted(group[theirs], group[ours], side="right") - first
            ends = np.cumsum(count)
            at = 0
            while at < len(ours):  # a bounded number of pairs at a time
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
                x = np.repeat(ours[at:to], count[at:to])
                y = theirs[ranges(first[at:to], count[at:to])]
                at = to
                apart = component[x] != component[y]
                x, y = x[apart], y[apart]
                once = (keys[x] == keys[y]).argmax(1) == band[x]  # in their first common bucket
                x, y = x[once], y[once]
                share = (sketch[x] == sketch[y]).mean(1)
                good = share >= LEAST_FINE
                x, y, share = x[good], y[good], share[good]
                if tries is not None and len(x):
                    order = np.lexsort((node[y], -share, x))
                    x, y = x[order], y[order]
                    starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                    place = np.arange(len(x)) - np.repeat(starts, np.diff(np.append(starts, len(x))))
                    x, y = x[place < tries], y[place < tries]
                a, b = node[x], node[y]
                yield pa.record_batch(
                    [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"]
                )

    return (
        marked.join(mixed, "key").select("key", "band", "node", "component", F.explode(places).alias("p"))
        .select("key", "p.i", "p.j", "band", "node", "component", "p.side").join(held, "node")
        .repartition(*by).sortWithinPartitions(*by)
        .select(*by, "band", "node", "component", "side", "keys", "fine")
        .mapInArrow(find, "a long, b long").distinct()
    )


def _verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """Pairs (a, b) whose texts are that similar, in a written table."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = WordHasher(), idf.value

        def bag(known, column, names):
            first = np.unique(names, return_index=True)[1]
            missing = [i for i in first if names[i] not in known]
            words, heads = hasher.words(column.take(pa.array(missing, pa.int64())))
            for j, i in enumerate(missing):
                known[names[i]] = shingles(words[heads[j] : heads[j + 1]], table)

        for batch in batches:
            for part in slices(batch, "text", 1 << 21):  # the other texts are about as long
                known, a, b = {}, part["a"].to_numpy(), part["b"].to_numpy()
                bag(known, part["text"], a)
                bag(known, part["other"], b)
                keep = [_similarity(known[x], known[y]) >= similarity - 1e-9 for x, y in zip(a, b)]
                good = pa.array(keep, pa.bool_())
                yield pa.record_batch([part["a"].filter(good), part["b"].filter(good)], names=["a", "b"])

    text = texts.select("node", "text")
    rows = pairs.join(text.withColumnRenamed("node", "a"), "a").join(text.toDF("b", "other"), "b")
    return materialize(rows.select("a", "b", "text", "other").mapInArrow(similar, "a long, b long"))


def _similarity(x, y) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    (ka, na, wa), (kb, nb, wb) = x, y
    at = np.minimum(np.searchsorted(kb, ka), max(len(kb) - 1, 0))
    if not len(ka) or not len(kb):
        return 0.0
    hit = kb[at] == ka
    common = float((np.minimum(na, nb[at]) * wa)[hit].sum())
    total = float((na * wa).sum() + (nb * wb).sum()) - common
    return common / total


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (doc_id, _f1, _f2, class_id, n_copies, kept), one per document.

    A class holds all documents tied by links of texts at least ``similarity`` alike, and
    equal texts; it is named by its smallest doc_id, whose rows are kept. ``n_copies``
    counts the documents of exactly this text. Word-less texts (null, empty, blanks) are
    like nothing, not even each other: each is its own class and kept. A null doc_id comes
    after all others, and names a class only if it has no other. Rows that repeat a kept
    doc_id and text are all marked kept. Texts are compared whole, in lower case, by words
    between ASCII white space.
    """
    docs = docs.select("doc_id", "text").withColumns(text_key())
    idf = docs.sparkSession.sparkContext.broadcast(word_idf(docs))
    rows = materialize(signatures(docs, idf))
    nodes = materialize(
        rows.groupBy("_f1", "_f2").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"),
            F.first("keys").alias("keys"), F.first("sketch").alias("sketch"),
        ).withColumn("node", F.monotonically_increasing_id())
    )
    bands = nodes.where("keys IS NOT NULL").select("node", F.posexplode("keys").alias("band", "key"))
    crowded = materialize(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    bands = materialize(bands.join(crowded, "key"))
    near = nodes.join(bands.select("node").distinct(), "node").select("node", "_f1", "_f2", "doc_id")
    near = materialize(near)
    # Never by broadcast: what has to be compared grows with the documents.
    texts = _texts(docs.join(
        near.hint("merge"), (docs["_f1"] == near["_f1"]) & (docs["_f2"] == near["_f2"])
        & docs["doc_id"].eqNullSafe(near["doc_id"])
    ).select("node", "text"))
    texts = materialize(texts.dropDuplicates(["node"]))

    pairs = materialize(_best_hubs(nodes, bands))
    tested, labels = pairs, materialize(components(_verified(pairs, texts, idf, similarity)))
    held = None
    for tries in (FIRST_TRIES, None):
        marked, mixed = _mixed(bands, labels)
        if mixed.isEmpty():  # no two texts of different classes share a bucket
            break
        if held is None:  # classes only grow together, so later rounds need no other texts
            fine = _fine_sketches(texts, marked.join(mixed.select("key"), "key"), idf)
            held = materialize(fine.join(nodes.select("node", "keys"), "node"))
        pairs = _cross_pairs(marked, mixed, held, tries)
        old = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = materialize(pairs.join(old, ["a", "b"], "left_anti"))
        if pairs.isEmpty():  # the best few may all be tested already, the next ones not
            continue
        labels = materialize(components(_verified(pairs, texts, idf, similarity), labels))
        tested = tested.union(pairs)

    member = nodes.select("_f1", "_f2", "node", "doc_id", "n_copies", "keys").join(labels, "node", "left")
    member = materialize(member.select(
        "_f1", "_f2", "node", "doc_id", "n_copies", F.coalesce("component", "node").alias("component"),
        F.col("keys").isNull().alias("blank"),
    ))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))
    heads = materialize(
        member.groupBy("component").agg(first.alias("first"))
        .select("component", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("head"))
    )
    fate = materialize(
        member.join(heads, "component")
        .select("_f1", "_f2", "n_copies", "class_id", (F.col("node") == F.col("head")).alias("heads"), "blank")
    )
    own = F.col("doc_id").eqNullSafe(F.col("class_id"))
    return rows.select("doc_id", "_f1", "_f2").join(fate, ["_f1", "_f2"]).select(
        "doc_id", "_f1", "_f2",
        F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "n_copies", (F.col("blank") | (F.col("heads") & own)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class of :func:`near_duplicates`, columns unchanged.

    Of rows that repeat the kept doc_id and text one stays (word-less ones all stay).
    """
    found = materialize(near_duplicates(docs, similarity))
    docs, restore = set_aside(docs)
    key = ["doc_id", "_f1", "_f2"]
    lost = materialize(found.where("NOT kept").select(*key).distinct())
    marked = docs.withColumns(text_key())

    def match(side: DataFrame):
        return (
            (marked["_f1"] == side["_f1"]) & (marked["_f2"] == side["_f2"])
            & marked["doc_id"].eqNullSafe(side["doc_id"])
        )

    left = marked.join(lost, match(lost), "left_anti")
    repeated = materialize(
        found.where("kept AND n_copies > 1").groupBy(*key).agg(F.count("*").alias("n"))
        .where("n > 1").select(*key)
    )
    if repeated.isEmpty():
        return restore(left.select(*docs.columns))
    marked = left
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    again = marked.join(repeated, match(repeated), "left_semi")
    single = marked.join(repeated, match(repeated), "left_anti")
    rest = single.union(again.where(blank)).union(again.where(~blank).dropDuplicates(key))
    return restore(rest.select(*docs.columns))
