"""N-gram Jaccard join with a token-group matrix.

1. Every document becomes the set of its word shingles' hashes. The chunks exchange their shingles by value and learn
   in how many documents each one stands. A document can be similar to another only if the wanted share of its
   shingles stands elsewhere too; the others are done.
2. Documents with equal sets are one *class* from here on. Classes are partitioned into groups by the smallest hash
   that they share with any other document (edits' own shingles part no copies); a large group is split. Within a group a matrix of leaders by tokens gives the exact overlap of each class with
   all leaders at once; a class joins the first leader it is similar to, or becomes a leader.
3. Token-group matrix: a group's token union stands for it. A class needs only look at groups that share one of its
   rarest tokens (so few that no similar set can avoid them all), and a group is opened only if the overlap with its
   union reaches what the wanted similarity needs. Opened groups are compared exactly, member by member.
   First only leaders ask, which joins the groups of copies to components; then every class asks for members of other
   components. So no link between different components is lost, and copies are not expanded to pairs.

Defined results: null or empty text has no shingles and no links; with fewer words than a shingle has, the whole
sequence is the only one; a null id never names a component, unless all ids in it are null; rows with equal ids are
documents of their own. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing as H
from millrace.llm.chunks import SENT, Chunks, answered, exchanged, give_back, pack, row_ids, sent, shares, stored, text_bytes
from millrace.llm.components import components

#: Classes and shingles in a group, and questions to a group that are answered at once.
GROUP_CLASSES = 2048
GROUP_TOKENS = 400_000
QUESTIONS = 256


def shingle_sets(rows: pa.Table, text: str, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, lower-cased (A-Z)."""
    data, bounds = text_bytes(rows.column(text))
    data = H.looked_up(H.LOWER, data)
    starts, ends, first = H.words_of(data, bounds)
    hashes = H.word_hashes(data, starts, ends)
    chains = H.chain(hashes, words)
    out = []
    for low, high in zip(first, first[1:]):
        if high - low >= words:
            out.append(np.unique(chains[low : high - words + 1]))
        else:
            out.append(H.chain(hashes[low:high], high - low) if high > low else np.zeros(0, np.uint64))
    return out


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` has in common with any similar one, at least."""
    return -(-percent * n // 100)


def document_counts(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For entries key, count: the binary logarithm of the key's number of documents, rounded down."""
    key, count = columns
    out = np.empty(len(key), np.uint8)
    for at in shares(key):
        keys, of = np.unique(key[at], return_inverse=True)
        total = np.bincount(of, weights=count[at], minlength=len(keys))
        out[at] = np.floor(np.log2(total)).astype(np.uint8)[of]
    return [out]


def all_tokens(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)


SETS = "row long, id long, n long, name binary, tokens binary, rare binary, token binary"


def candidates(chunks: Chunks, id_column: str, text: str, words: int, percent: int) -> DataFrame:
    """Every document; those that may have a similar one with their set's name, shingles and rarest shingles."""
    buckets = chunks.parts()

    def keys(chunk: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tokens, count = all_tokens(shingle_sets(rows, text, words))
        yield from sent(chunk, tokens, [tokens.astype(np.uint32), np.minimum(count, 255).astype(np.uint8)], buckets)

    def sets(chunk: int, rows: pa.Table, got: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = shingle_sets(rows, text, words)
        common = answered(got, np.uint8)
        tokens, _ = all_tokens(found)
        names, full, rare, least = [], [], [], []
        for own in found:
            degree = common[np.searchsorted(tokens, own)]
            need = needed(len(own), percent)
            if not len(own) or np.count_nonzero(degree) < need:
                names.append(None), full.append(None), rare.append(None), least.append(None)
                continue
            order = np.lexsort((own, degree))[: len(own) - need + 1]
            names.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            full.append(own.tobytes())
            rare.append(own[order[degree[order] > 0]].tobytes())
            least.append(own[degree > 0][:1].tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array(row_ids(chunk, len(found))),
                "id": rows.column(id_column).cast(pa.int64()).combine_chunks(),
                "n": pa.array([len(x) for x in found], pa.int64()),
                "name": pa.array(names, pa.binary()),
                "tokens": pa.array(full, pa.binary()),
                "rare": pa.array(rare, pa.binary()),
                "token": pa.array(least, pa.binary()),
            }
        )

    counts = exchanged(chunks.map(keys, SENT), [np.uint32, np.uint8], document_counts)
    return stored(chunks.map_with([counts], sets, SETS), "sets")


def decoded(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in column]


class Matrix:
    """Sets by tokens: the sets that are in it, as places in the union of a group's tokens, one after the other."""

    def __init__(self, sets: list[np.ndarray]):
        self.union = np.unique(np.concatenate(sets))
        self.cells = np.empty(sum(map(len, sets)), np.int32)
        self.starts = np.zeros(len(sets), np.int64)
        self.sizes = np.zeros(len(sets), np.int64)
        self.n = self.used = 0

    def places(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.union, own)
        at[at == len(self.union)] = 0
        return at[self.union[at] == own]

    def add(self, own: np.ndarray) -> None:
        self.cells[self.used : self.used + len(own)] = self.places(own)
        self.starts[self.n], self.sizes[self.n] = self.used, len(own)
        self.n, self.used = self.n + 1, self.used + len(own)

    def similar(self, own: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets that are similar to ``own``."""
        places = self.places(own)
        # Perhaps not even the union has enough of it.
        if not self.n or len(places) < needed(len(own), percent):
            return np.zeros(0, np.int64)
        row = np.zeros(len(self.union), np.int32)
        row[places] = 1
        overlap = np.add.reduceat(row[self.cells[: self.used]], self.starts[: self.n])
        return np.flatnonzero(100 * overlap >= percent * (len(own) + self.sizes[: self.n] - overlap))


def grouped(classes: DataFrame, percent: int) -> DataFrame:
    """``classes`` with their group (``token``, ``part``) and the leader each one is similar to."""
    parts = classes.groupBy("token").agg(
        F.greatest(F.ceil(F.count("*") / GROUP_CLASSES), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("parts")
    )
    keyed = classes.join(parts, "token").withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")

    def lead(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        sets = decoded(rows.column("tokens"))
        matrix, leaders, out = Matrix(sets), [], []
        ids = rows.column("row").to_pylist()
        for row, own in zip(ids, sets):
            similar = matrix.similar(own, percent)
            if not len(similar):
                matrix.add(own)
                leaders.append(row)
            out.append(leaders[similar[0]] if len(similar) else row)
        give_back()
        return rows.append_column("leader", pa.array(out, pa.int64()))

    schema = f"{', '.join(f'`{n}` {t}' for n, t in keyed.dtypes)}, leader long"
    return stored(keyed.groupBy("token", "part").applyInArrow(lead, schema), "groups")


def questions(asking: DataFrame, groups: DataFrame, root: str, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between classes of ``asking`` and members of ``groups`` with another value of ``root``."""
    rare = F.explode(longs("rare")).alias("rare_token")
    held = (
        groups.select(rare, "token", "part", F.col(root).alias("root"), "n")
        .groupBy("rare_token", "token", "part")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("n").alias("low"), F.max("n").alias("high"))
    )
    several = held.groupBy("rare_token").agg(F.min("least").alias("x"), F.max("most").alias("y")).where("x < y")
    held = held.join(several.select("rare_token"), "rare_token", "left_semi")
    asked = asking.select("row", F.col(root).alias("own"), F.col("n").alias("size"), rare)
    fits = (F.col("own") != F.col("least")) | (F.col("own") != F.col("most"))
    fits &= 100 * F.col("high") >= percent * F.col("size")
    fits &= percent * F.col("low") <= 100 * F.col("size")
    pairs = asked.join(held, (asked.rare_token == held.rare_token) & fits).select("row", "token", "part").distinct()
    pairs = stored(pairs, "pairs")
    blocks = pairs.groupBy("token", "part").agg(F.ceil(F.count("*") / QUESTIONS).alias("blocks"))
    pairs = pairs.join(blocks, ["token", "part"]).withColumn("block", F.pmod(F.xxhash64("row"), "blocks")).drop("blocks")
    entry = F.struct("row", F.col(root).alias("root"), "tokens")
    asked = (
        pairs.join(asking.select("row", root, "tokens"), "row")
        .groupBy("token", "part", "block")
        .agg(F.collect_list(entry).alias("asked"))
    )
    members = groups.groupBy("token", "part").agg(F.collect_list(entry).alias("members"))
    both = asked.join(members, ["token", "part"]).select("asked", "members")

    def answer(batches):
        for batch in batches:
            for asked, members in zip(batch.column("asked").to_pylist(), batch.column("members").to_pylist()):
                sets = [np.frombuffer(m["tokens"], np.uint64) for m in members]
                matrix = Matrix(sets)
                for own in sets:
                    matrix.add(own)
                links = [
                    (q["row"], members[i]["row"])
                    for q in asked
                    for i in matrix.similar(np.frombuffer(q["tokens"], np.uint64), percent)
                    if members[i]["root"] != q["root"]
                ]
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
            give_back()

    return both.mapInArrow(answer, "a long, b long")


def longs(column: str) -> Column:
    """The 8-byte pieces of a binary column."""
    pieces = F.expr(f"transform(sequence(1, octet_length({column}) - 7, 8), i -> substring({column}, i, 8))")
    return F.when(F.octet_length(column) > 0, pieces)


def rooted(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` with the smallest class of the component that the links give, ``root``."""
    found = components(links).withColumnRenamed("node", "row")
    return groups.drop("root").join(found, "row", "left").withColumn("root", F.coalesce("root", "row"))


class Similar:
    """Documents by component. ``documents`` has row, id, n, component (smallest id) and keeper (the one row of the
    component that stays when copies go: the smallest id's, then the smallest row)."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80):
        self.schema = docs.schema
        self.chunks = Chunks(docs, text)
        self.sets = candidates(self.chunks, id_column, text, words, percent)
        named = self.sets.where("name is not null")
        firsts = stored(named.groupBy("name").agg(F.min("row").alias("row")), "firsts")
        classes = named.join(firsts.select("row"), "row", "left_semi").drop("id", "name")
        groups = grouped(classes, percent)
        stars = groups.where("row <> leader").select(F.col("row").alias("a"), F.col("leader").alias("b"))
        leaders = groups.where("row = leader")
        links = stored(stars.unionByName(questions(leaders, groups, "leader", percent)), "links")
        joined = stored(rooted(groups, links), "rooted")
        links = links.unionByName(questions(joined, joined, "root", percent))
        roots = rooted(groups, links).select("row", "root")
        self.named = named.select("row", "id", "name")
        self.of_name = stored(firsts.join(roots, "row").select("name", "root"), "of_name")

    def joined(self, value: Column, name: str) -> DataFrame:
        """Rows row, id and the smallest ``value`` of their component as ``name``.

        It is found by class of equal sets and then by component; a row meets its class only. All joins are between
        stored tables, so that a class or component with a third of all rows is split."""
        own = self.named.groupBy("name").agg(F.min(value).alias(name))
        classes = stored(own.join(self.of_name, "name"), "classes")
        least = stored(classes.groupBy("root").agg(F.min(name).alias(name)), "least")
        by_class = stored(classes.select("name", "root").join(least, "root").select("name", name), "by_class")
        return self.named.join(by_class, "name").select("row", "id", name)

    def documents(self) -> DataFrame:
        """Rows row, id, n, component."""
        found = self.joined(F.col("id"), "component").select("row", "component")
        rows = self.sets.select("row", "id", "n").join(found, "row", "left")
        return rows.withColumn("component", F.coalesce("component", "id"))

    def kept(self) -> DataFrame:
        """The given documents without all but one of each component."""
        found = self.joined(F.struct(F.col("id").isNull().alias("none"), "id", "row"), "first")
        gone = found.where(F.col("row") != F.col("first.row")).select("row")
        place = F.shiftrightunsigned("row", 20).alias("chunk"), F.col("row").bitwiseAND((1 << 20) - 1).cast("int").alias("place")
        lists = gone.select(*place).groupBy("chunk").agg(F.collect_list("place").alias("places"))

        def packed(batches):
            for batch in batches:
                blobs = [pack(np.array(x.as_py(), np.uint32).tobytes()) for x in batch.column("places")]
                yield pa.RecordBatch.from_pydict(
                    {"chunk": batch.column("chunk"), "bucket": pa.array([0] * len(blobs), pa.int32()), "entries": pa.array(blobs, pa.binary())}
                )

        def keep(_: int, rows: pa.Table, got: list[bytes]) -> Iterator[pa.RecordBatch]:
            stays = np.ones(rows.num_rows, bool)
            stays[answered(got, np.uint32)] = False
            yield from rows.filter(pa.array(stays)).to_batches()

        return self.chunks.map_with([lists.mapInArrow(packed, "chunk long, bucket int, entries binary")], keep, self.schema)
