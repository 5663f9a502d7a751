"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Texts are sets of five-word shingles; two texts are linked if their Jaccard
similarity is at least ``THRESHOLD``.  Only distinct texts are compared.

1. Every distinct text gets ``HASHES`` MinHash values, cut into bands.  Linked
   texts share no band with a probability of at most (1 - t^ROWS)^BANDS, 5e-8.
2. Within a band's bucket the values (one byte of each) are compared a few at
   a time, and a pair is dropped as soon as the posterior probability that it
   reaches the threshold is below ``TOLERANCE``.  What survives is gathered
   into components.  A bucket too large for one task is kept together whole.
3. A component's texts are cut into blocks; each pair of blocks is one unit of
   work, in which pairs are pruned again and the rest verified on the exact
   shingle sets.  A unit returns counts of links and a spanning forest of
   them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_slices, partitions, read_table, ship_by_value, written
from tessera.llm.components import connected_components
from tessera.llm.shingles import WordHashes, minhash, mixed, permutations, shingle_set, sorted_groups, word_hashes

ship_by_value(__name__)

THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: A pair is dropped when it reaches the threshold with less than this posterior probability.
TOLERANCE = 1e-7
#: MinHash values compared at a time.
CHUNK = 16
#: Members of a bucket that one task prunes; a larger bucket is one candidate group.
BUCKET = 4096
#: Texts and bytes of shingles in a block.
BLOCK, BLOCK_BYTES = 256, 16 << 20
#: Distinct candidate texts whose digests may be broadcast (about 50 bytes each).
BROADCAST_TEXTS = 500_000

SIGNED = "digest string, shingles int, bands binary, sketch binary"
EDGES = "a long, b long"
LINKS = "a long, b long, links long"


def text_digest(text: Column) -> Column:
    """Equal for equal texts; null for null."""
    return F.md5(text)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words, (xor, odd) = WordHashes(), permutations(HASHES)
    place = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    for batch in batches:
        rows = []
        for digest, text in batch[["digest", "text"]].itertuples(index=False):
            found = shingle_set(word_hashes(text, words))
            if not len(found):
                rows.append((digest, 0, None, None))
                continue
            values = minhash(found, xor, odd)
            key = place.copy()
            for column in values.reshape(BANDS, ROWS).T.astype(np.uint64):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
            rows.append((digest, len(found), key.astype("<u8").tobytes(), (values & np.uint32(255)).astype(np.uint8).tobytes()))
        yield pd.DataFrame(rows, columns=["digest", "shingles", "bands", "sketch"])


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For 0, CHUNK, 2 CHUNK, ... compared values the fewest matches with which a pair stays.

    The similarity is uniform before; a value matches with the similarity s,
    or by chance in one of 256 cases.
    """
    s = (np.arange(4000) + 0.5) / 4000
    match = s + (1 - s) / 256
    out = []
    for n in range(0, HASHES + 1, CHUNK):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() >= tolerance * weight.sum():
                break
        out.append(m)
    return tuple(out)


def surviving(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which rows of ``many`` may be similar to ``one``: sketches compared chunk by chunk, hopeless rows dropped on the way."""
    least = least_matches()
    at, matches = np.arange(len(many)), np.zeros(len(many), np.int32)
    for step in range(1, HASHES // CHUNK + 1):
        cut = slice((step - 1) * CHUNK, step * CHUNK)
        matches = matches + (many[at, cut] == one[cut]).sum(axis=1)
        stay = matches >= least[step]
        if not stay.all():
            at, matches = at[stay], matches[stay]
        if not len(at):
            break
    return at


def _sketches(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), HASHES)


def _prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every bucket the components of its surviving pairs, as edges to their first member."""
    edges: list[tuple[int, int]] = []
    for _, bucket in sorted_groups(batches, "bucket"):
        ids, sketches = bucket["vid"].to_numpy(), _sketches(bucket["sketch"])
        left = np.arange(len(ids))
        while len(left) > 1:
            root, left, queue = left[0], left[1:], [left[0]]
            while queue and len(left):
                near = surviving(sketches[queue.pop()], sketches[left])
                if len(near):
                    queue.extend(left[near])
                    edges.extend((int(ids[root]), int(ids[i])) for i in left[near])
                    left = np.delete(left, near)
        if len(edges) >= 50_000:
            yield pd.DataFrame(edges, columns=["a", "b"])
            edges = []
    yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(vid, digest, first_id, copies, shingles, bands, sketch) of every distinct text that isn't null, written; ``vid`` numbers them."""
    keyed = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))
    counted = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    signed = (map_slices(docs.filter(F.col("text").isNotNull()).select(text_digest(F.col("text")).alias("digest"), "text"), _sign, SIGNED)
              .groupBy("digest").agg(F.first("shingles").alias("shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    return written(counted.join(signed, "digest").withColumn("vid", F.monotonically_increasing_id()), "texts")


def candidate_components(texts: DataFrame) -> DataFrame:
    """(node, component) of the texts that share a bucket with another and survive the pruning there."""
    spark = texts.sparkSession
    key = F.xxhash64(F.substring(F.col("bands"), F.col("band") * 8 + 1, F.lit(8)), F.col("band"))
    bands = (texts.filter("shingles > 0").select("vid", "bands", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
             .select("vid", key.alias("bucket")))
    # written before they join, so that Spark can split the join's hot keys
    shared = written(bands.groupBy("bucket").agg(F.count("*").alias("members"), F.min("vid").alias("least")).filter("members > 1"), "shared")
    placed = written(bands.join(shared, "bucket"), "buckets")
    small = (placed.filter(F.col("members") <= BUCKET).select("bucket", "vid")
             .join(texts.select("vid", "sketch"), "vid"))
    pruned = map_slices(small.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "vid"), _prune, EDGES, 5000)
    whole = placed.filter((F.col("members") > BUCKET) & (F.col("vid") != F.col("least"))).select(F.col("least").alias("a"), F.col("vid").alias("b"))
    return connected_components(pruned.unionAll(whole))


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = WordHashes()
    for batch in batches:
        yield batch.drop(columns="text").assign(set=[shingle_set(word_hashes(t, words)).tobytes() for t in batch["text"]])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets: products of their indicator matrices, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1  # a shingle of one text alone is in no intersection
    names, column = np.unique(column[shared], return_inverse=True)
    owner, out = owner[shared], np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, len(names), _COLUMNS):
        a, b = np.searchsorted(column, (low, low + _COLUMNS))
        cells = np.zeros((len(sets), min(_COLUMNS, len(names) - low)), np.float32)
        cells[owner[a:b], column[a:b] - low] = 1
        out += cells @ cells.T
    return out


_COLUMNS = 4096


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every pair of blocks: (vid, root, links), where links counts the documents linked to vid by this pair."""
    rows: list[tuple[int, int, int]] = []
    for _, unit in sorted_groups(batches, "unit"):
        vids, copies = unit["vid"].to_numpy(), unit["copies"].to_numpy()
        sides, same = unit["side"].to_numpy(), bool(unit["same"].iat[0])
        sketches, sets = _sketches(unit["sketch"]), [np.frombuffer(s, np.uint64) for s in unit["set"]]
        may = np.zeros((len(vids), len(vids)), bool)
        for i in range(len(vids)):
            others = np.flatnonzero((np.arange(len(vids)) > i) & (True if same else sides != sides[i]))
            may[i, others[surviving(sketches[i], sketches[others])]] = True
        if not may.any():
            continue
        sizes, common = np.array([len(s) for s in sets]), _overlaps(sets)
        # whole numbers: exact at the threshold
        first, second = np.nonzero(may & (common * 1000 >= round(THRESHOLD * 1000) * (sizes[:, None] + sizes[None, :] - common)))
        root = list(range(len(vids)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = np.zeros(len(vids), np.int64)
        np.add.at(links, first, copies[second])
        np.add.at(links, second, copies[first])
        for i, j in zip(first.tolist(), second.tolist(), strict=True):
            x, y = top(i), top(j)
            if x != y:
                root[max(x, y)] = min(x, y)
        rows.extend((int(vids[i]), int(vids[top(i)]), int(links[i])) for i in np.flatnonzero(links))
        if len(rows) >= 50_000:
            yield pd.DataFrame(rows, columns=["a", "b", "links"])
            rows = []
    yield pd.DataFrame(rows, columns=["a", "b", "links"], dtype="int64")


def verified_links(docs: DataFrame, texts: DataFrame, components: DataFrame) -> DataFrame:
    """(a, b, links), written: for a text and a unit of work a text it is connected to, and the documents linked to it there."""
    spark = docs.sparkSession
    members = texts.join(components.withColumnRenamed("node", "vid"), "vid")
    sizes = members.groupBy("component").agg(F.count("*").alias("texts"), F.sum("shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    wanted = written(members.join(sizes.select("component", blocks.alias("blocks")), "component")
                     .select("digest", "first_id", "vid", "component", "blocks", "copies", "sketch"), "wanted")
    slim = wanted.select("digest", "first_id", "vid")
    slim = F.broadcast(slim) if wanted.count() <= BROADCAST_TEXTS else slim
    keyed = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"), "text")
    found = keyed.join(slim, (keyed["digest"] == slim["digest"]) & keyed["doc_id"].eqNullSafe(slim["first_id"])).select("vid", "text")
    sets = (map_slices(found, _sets, "vid long, set binary")
            .groupBy("vid").agg(F.first("set").alias("set")))  # of rows equal in id and text, one
    block = F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")
    other = F.col("other")
    dealt = (wanted.join(sets, "vid").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("component", F.least("block", other), F.greatest("block", other)).alias("unit"),
                     "vid", "copies", "sketch", "set", (F.col("block") == other).alias("same"),
                     F.col("block").alias("side")))
    return written(map_slices(dealt.repartition(partitions(spark), "unit").sortWithinPartitions("unit", "vid"), _verify, LINKS), "links")


def text_classes(docs: DataFrame) -> DataFrame:
    """(digest, component, class_id, n_links) of every distinct text that isn't null, written; see ``jaccard_classes``."""
    texts = distinct_texts(docs)
    links = verified_links(docs, texts, candidate_components(texts))
    classes = connected_components(links.select("a", "b")).withColumnRenamed("node", "vid")
    counts = links.groupBy(F.col("a").alias("vid")).agg(F.sum("links").alias("links"))
    told = (texts.select("vid", "digest", "first_id", "copies").join(classes, "vid", "left").join(counts, "vid", "left")
            .withColumn("component", F.coalesce("component", "vid")))
    firsts = told.groupBy("component").agg(F.min("first_id").alias("class_id"))
    # texts linked to no other name their own class
    return written(told.join(firsts, "component").select(
        "digest", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of every document.

    ``class_id`` is the smallest id of the documents that chains of links
    reach; ``n_links`` counts the other documents, copies included, at a
    similarity of at least ``THRESHOLD``.

    Null text: no links, a class of its own.  Texts without words: linked to
    equal texts only.  Fewer than five words make one shingle.  Repeated ids
    and rows: each row is a document.  A class without any id: class_id is
    null.  Empty table: empty result.  Other columns are not read.
    """
    classes = text_classes(docs).select("digest", "class_id", "n_links")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))
    return (keyed.join(classes, "digest", "left")
            .select("doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_one_row(docs: DataFrame) -> DataFrame:
    """The documents, with their columns, with one row of each class: the smallest id's, of rows without any id any.

    Rows are judged by their text, whatever rows have the same id or none; of a
    class's texts under its smallest id the one with the smallest digest stays.
    Rows without a text all stay.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("of"),
                      text_digest(F.col("text")).alias("digest"))
    rows = own.filter("digest is not null").groupBy("digest", "of").agg(F.count("*").alias("times"))
    # written before they join, so that Spark can split a hot text's rows
    told = written(written(rows, "rows").join(text_classes(docs).select("digest", "component"), "digest"), "told")
    first = F.min(F.struct(F.col("of").isNull().alias("no_id"), "of", "digest", "times")).alias("first")
    kept = written(told.groupBy("component").agg(first).select("first.of", "first.digest", "first.times"), "kept")

    def matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col("digest").alias("its_digest"), F.col("of").alias("its_id"))
        return left.join(right, (left["digest"] == right["its_digest"]) & left["of"].eqNullSafe(right["its_id"]), how)

    left = matching(own, written(matching(told, kept, "left_anti").select("digest", "of"), "gone"), "left_anti")
    again = kept.filter("times > 1")
    if again.isEmpty():
        return left.select("row.*")
    once = matching(left, again, "left_semi").dropDuplicates(["digest"])
    return matching(left, again, "left_anti").unionAll(once).select("row.*")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with their columns, without all but the one with the smallest id of each class.

    Rows without an id or a text all stay.  An id is one document: of repeated
    rows with the kept id, one stays.
    """
    known = written(jaccard_classes(docs), "known")
    gone = known.filter("doc_id <> class_id").select(F.col("doc_id").alias("gone_id")).distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("of"))
    left = own.join(gone, own["of"] == gone["gone_id"], "left_anti")
    if known.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return left.select("row.*")
    once = left.filter("of is not null and row.text is not null").dropDuplicates(["of"])
    return once.unionAll(left.filter("of is null or row.text is null")).select("row.*")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read_table(spark, sf_dir, "documents"))
