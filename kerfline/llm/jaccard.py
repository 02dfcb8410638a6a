"""N-gram Jaccard join by filtering under several global orders of the tokens.

Two sets of Jaccard similarity t or more share many tokens, so under any one order of
all tokens their first tokens (a prefix of 1 - t of each set, and a little more) must
meet. A pair has to meet so under three orders before it is verified:

* B, a hash of the token. Longer prefixes are used, in which a set must meet others in
  several tokens. Sets that do not are done: they are linked with nothing.
* A, rare tokens first, by their frequency among the sets that are left. Its prefixes
  give the candidates; a set with too many tokens of its own has none.
* C, a third hash, and B again, for the pair itself, just before verification.

Equal sets are one node from the start. Candidates of a token are not all pairs: each set
is verified against a leader first and linked sets merge into components; only tokens
that still join different components go on. Their sets travel to cells of bounded size,
first one block of each group of tokens against all of it, then the other blocks, and a cell applies
the filters to its sets and gives only the links that join components in it. So every
link between different components is found, and pairs are never rows of their own. The
result is the components of the full link graph, not all its links.

Defined cases: null texts and texts without words have no shingles and stand alone; texts
of fewer words than a shingle are one shingle; repeated rows get one component; a null id
never is a component's least id unless all are null; a very long text is handled whole, its
shingles at once; an empty table gives no rows; other columns are not looked at.
Tokens and sets are known by 64-bit hashes; before verification 32 bits of a token do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .components import components

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALTS = {"A": np.uint64(0x2545F4914F6CDD1D), "B": np.uint64(0x9E6C63D0876A9A47), "C": np.uint64(0xD1B54A32D192ED03)}


def shingles(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingle of each of the n texts (n + 1 places), and the distinct 64-bit shingles of every text, sorted in each."""
    data, starts, _ = blocks.separated(column)
    data = _LOWER[data]
    s, e = blocks.runs(~_SPACE[data])
    h = blocks.range_hashes(blocks.prefix_sums(blocks.BYTE_VALUES[data]), s, e)
    doc = np.searchsorted(starts, s, side="right") - 1
    count = np.bincount(doc, minlength=len(starts))
    parts = []
    if len(h) >= words:
        x = np.zeros(len(h) - words + 1, np.uint64)
        for k in range(words):
            x = blocks.mix64(x * np.uint64(31) + h[k : len(h) - words + 1 + k])
        inside = doc[: len(x)] == doc[words - 1 :]
        parts.append((doc[: len(x)][inside], x[inside]))
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = (np.cumsum(count) - count)[short]
        x = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            more = count[short] > k
            x[more] = blocks.mix64(x[more] * np.uint64(31) + h[first[more] + k])
        parts.append((short, blocks.mix64(x + np.uint64(1))))
    if not parts:
        return np.zeros(len(starts) + 1, np.int64), np.zeros(0, np.uint64)
    doc, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((x, doc))
    doc, x = doc[order], x[order]
    new = np.concatenate(([True], (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])))
    doc, x = doc[new], x[new]
    return np.searchsorted(doc, np.arange(len(starts) + 1)), x


def nodes_of(first: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; empty sets get 0."""
    size = np.diff(first)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(blocks.mix64(x ^ _SALTS["A"]), dtype=np.uint64)))
    more = np.concatenate((np.zeros(1, np.uint64), np.cumsum(blocks.mix64(x ^ _SALTS["B"]), dtype=np.uint64)))
    name = blocks.mix64(blocks.mix64(sums[first[1:]] - sums[first[:-1]]) + (more[first[1:]] - more[first[:-1]]) + size.astype(np.uint64))
    return np.where(size > 0, name, 0).astype(np.uint64).view(np.int64)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest tokens that a set of n shares with any set that it links with."""
    return -(-n * percent // 100)


def prefix_of(tokens: np.ndarray, order: str, size: int) -> np.ndarray:
    """The first `size` tokens of one set under a hashed order."""
    if size >= len(tokens):
        return tokens
    return tokens[np.argpartition(blocks.mix64(tokens ^ _SALTS[order]), size - 1)[:size]]


def short(tokens: np.ndarray) -> np.ndarray:
    """32 bits of each token: enough to meet by, as different tokens that meet only cost a verification."""
    return (tokens >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            first, x = shingles(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes_of(first, x)), pa.array(np.diff(first))], names=["doc_id", "node", "n"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n long")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85, text: str = "text", doc_id: str = "doc_id", slack: int = 5, broadcast_rows: int = 1_000_000, cell_tokens: int = 300_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    blocks.small_batches(docs)
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = blocks.cut(_sets(docs, words))
    nodes = base.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least"))

    # order B: prefixes of 1 - t + slack of every set; a set must meet others in about `slack` percent of its tokens
    def first_tokens(batches):
        for batch in blocks.sliced(batches, "text"):
            first, x = shingles(batch.column(1), words)
            size = np.diff(first)
            want = np.minimum(size - least_overlap(size, percent) + 1 + size * slack // 100, size)
            order = np.lexsort((blocks.mix64(x ^ _SALTS["B"]), np.repeat(np.arange(len(size)), size)))
            place = np.arange(len(x)) - np.repeat(first[:-1], size)
            pick = place < np.repeat(want, size)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes_of(first, x), size)[pick]), pa.array(short(x[order][pick]))], names=["node", "token"])

    tokens = docs.mapInArrow(first_tokens, "node long, token int")
    met = tokens.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    hits = tokens.join(met, "token").groupBy("node", "rows").agg(F.count("*").alias("hits")).join(nodes, "node").where("rows > copies")
    need = 1 + F.floor(F.ceil(F.col("n") * percent / 100) * slack / 100)  # the other set may be smaller, and so its longer prefix
    left = hits.groupBy("node", "n", "copies").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= need * F.col("copies")).select("node")
    left = blocks.cut(left)

    # the sets that are left, each once; one Python worker does it all, as every worker of a stage keeps its memory
    def listed(batches):
        seen = set()
        for batch in blocks.sliced(batches, "text"):
            first, x = shingles(batch.column(0), words)
            raw, ids = x.tobytes(), nodes_of(first, x).tolist()
            fresh = [i for i, node in enumerate(ids) if node and not (node in seen or seen.add(node))]
            if len(seen) > 200_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in fresh], pa.int64()), pa.array([raw[8 * first[i] : 8 * first[i + 1]] for i in fresh], pa.binary())], names=["node", "tokens"])

    found = left.count()
    few = F.broadcast(left) if found <= broadcast_rows else left
    rows = docs.select("text").mapInArrow(listed, "node long, tokens binary").join(few, "node")
    sets = blocks.cut(rows.groupBy("node").agg(F.first("tokens").alias("tokens")))
    known = _linked(sets, percent, found, cell_tokens)
    if known is None:
        labels = nodes.select("node", F.col("node").alias("label"))
    else:
        labels = nodes.select("node").join(known, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    smallest = nodes.select("node", "least").join(labels, "node")
    smallest = smallest.join(smallest.groupBy("label").agg(F.min("least").alias("component")), "label").select("node", "component")
    joined = base.join(smallest, "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).cast(kind).alias("component_id"))


def _linked(sets: DataFrame, percent: int, found: int, cell_tokens: int) -> DataFrame | None:
    """(node, label) of those of sets(node, tokens) that link with others; None if none do."""
    if not found:
        return None

    def exploded(batches):
        for batch in batches:
            parts = [short(np.frombuffer(t, np.uint64)) for t in batch.column(1).to_pylist()]
            for at in range(0, len(parts), 500):
                some = parts[at : at + 500]
                sizes = [len(p) for p in some]
                node = np.repeat(batch.column(0).to_numpy()[at : at + 500], sizes)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(some)), pa.array(np.repeat(sizes, sizes).astype(np.int32))], names=["node", "token", "n"])

    every = sets.mapInArrow(exploded, "node long, token int, n int")
    common = every.groupBy("token").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    # the tokens of its own come first in a set's prefix; what is left of it goes to the rarest others
    listed = every.join(common, "token").groupBy("node", "n").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    more = F.size("shared") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    posted = listed.where(more > 0).select("node", F.col("n").cast("long").alias("n"), F.explode(F.slice(F.array_sort("shared"), F.lit(1), more)).alias("t")).select(F.col("t.token").alias("token"), "node", "n")
    posted = blocks.cut(posted)
    links, labels = None, None
    for meeting in (_leaders, _first_cells, _other_cells):
        rows = posted.withColumn("label", F.col("node")) if labels is None else posted.join(labels, "node", "left").select("token", "node", "n", F.coalesce("label", "node").alias("label"))
        new = meeting(rows, sets, percent, cell_tokens)
        if new is not None:
            links = new if links is None else links.union(new)
            labels = components(links)
    return labels


def _leaders(rows: DataFrame, sets: DataFrame, percent: int, cell_tokens: int) -> DataFrame | None:
    """Links of each set with the leader that it meets in most tokens."""
    lists = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct("node", "n", "label")).alias("lead")).where("lo <> hi")
    met = rows.join(lists.select("token", "lead"), "token").select("node", "n", "label", F.col("lead.node").alias("other"), F.col("lead.n").alias("other_n"), F.col("lead.label").alias("other_label"))
    pairs = met.where("label <> other_label").where(F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent)
    pairs = pairs.groupBy("node", "other").agg(F.count("*").alias("c")).groupBy("node").agg(F.max_by("other", F.struct("c", "other")).alias("other"))
    return _some(verify(blocks.cut(pairs), sets, percent))


def _some(links: DataFrame) -> DataFrame | None:
    links = blocks.cut(links)
    return links if links.limit(1).count() else None


def _first_cells(rows: DataFrame, sets: DataFrame, percent: int, cell_tokens: int) -> DataFrame | None:
    """Links inside the small groups, and between the first block of each large group and the whole of it.

    Tokens with the same least set form a group. One whose sets hold more than cell_tokens
    tokens is split into blocks; smaller groups share cells of about that size. Sets
    travel to cells, not pairs.
    """
    active = _groups(rows, cell_tokens)
    weight = active.where("k = 1").agg(F.sum("n")).first()[0] or 0
    where = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array("block"))
    cell = F.when(F.col("k") == 1, F.pmod(F.xxhash64("lead"), F.lit(weight // cell_tokens + 1))).otherwise(F.col("lead"))
    placed = active.select(cell.alias("cell"), F.when(F.col("k") == 1, -1).otherwise(0).alias("i"), F.explode(where).alias("j"), "block", "node", "label", "via")
    return _some(_compare(placed, sets, percent))


def _other_cells(rows: DataFrame, sets: DataFrame, percent: int, cell_tokens: int) -> DataFrame | None:
    """Links between the other blocks of the large groups that still join different components."""
    placed = _groups(rows, cell_tokens).where("block > 0").withColumn("to", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    placed = placed.select(F.col("lead").alias("cell"), F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "block", "node", "label", "via")
    return _some(_compare(placed, sets, percent))


def _groups(rows: DataFrame, cell_tokens: int) -> DataFrame:
    """The sets of each group with the tokens that still join different components; k and block do not depend on the labels."""
    lists = rows.groupBy("token").agg(F.min("node").alias("lead"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m")).where("m > 1")
    still = F.collect_set(F.when(F.col("lo") != F.col("hi"), F.col("token")))
    members = blocks.cut(rows.join(lists, "token").groupBy("lead", "node", "n", "label").agg(still.alias("via")))
    sizes = members.groupBy("lead").agg(F.ceil(F.sum("n") / cell_tokens).cast("int").alias("k"))
    active = members.where(F.size("via") > 0).join(sizes, "lead")
    return active.withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("k")).cast("int"))


class _Postings:
    """Which of some sets hold each token."""

    def __init__(self, lists: list[np.ndarray]):
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), sizes)
        order = np.argsort(flat, kind="stable")
        new = np.concatenate(([True], np.diff(flat[order]) != 0))
        kind = np.empty(len(flat), np.int64)
        kind[order] = np.cumsum(new) - 1
        self.owner, self.first = owner[order], np.append(np.flatnonzero(new), len(flat))
        self.kind, self.at, self.n = kind, np.append(0, np.cumsum(sizes)), len(lists)

    def shared(self, i: int) -> np.ndarray:
        """How many tokens each set shares with set i."""
        kinds = self.kind[self.at[i] : self.at[i + 1]]
        begin, size = self.first[kinds], self.first[kinds + 1] - self.first[kinds]
        place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.owner[place], minlength=self.n)


def _compare(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) that join the components inside each cell of placed(cell, i, j, block, node, label, via).

    Sets of one cell are candidates if they share a token that brought them there and,
    under each of the other two orders, one in their prefixes. Cells (i, j) of two
    blocks compare one with the other.
    """

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        node, block = pdf["node"].to_numpy(), pdf["block"].to_numpy()
        cross = pdf["i"].iloc[0] >= 0 and pdf["i"].iloc[0] != pdf["j"].iloc[0]
        component = np.unique(pdf["label"].to_numpy(), return_inverse=True)[1]
        out = []
        if component.any():
            tokens = [np.frombuffer(t, np.uint64) for t in pdf["tokens"]]
            n = np.array([len(t) for t in tokens])
            orders = [_Postings([np.asarray(v) for v in pdf["via"]])] + [_Postings([prefix_of(t, o, _size(t, percent)) for t in tokens]) for o in ("B", "C")]
            every = _Postings(tokens)
            for i in range(len(node)):
                hit = (component != component[i]) & (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent)
                hit[:i] = False
                if cross:
                    hit &= block != block[i]
                for postings in orders:
                    if hit.any():
                        hit &= postings.shared(i) > 0
                found = np.flatnonzero(hit)
                if len(found):
                    both = every.shared(i)[found]
                    for k in found[100 * both >= percent * (n[found] + n[i] - both)]:
                        if component[k] != component[i]:
                            component[component == component[k]] = component[i]
                            out.append((node[i], node[k]))
        return pd.DataFrame(out, columns=["x", "y"], dtype=np.int64)

    came = placed.groupBy("cell", "i", "j", "block", "node", "label").agg(F.flatten(F.collect_list("via")).alias("via"))
    return came.join(sets, "node").groupBy("cell", "i", "j").applyInPandas(test, "x long, y long")


def verify(pairs: DataFrame, sets: DataFrame, percent: int, group: int = 500) -> DataFrame:
    """The pairs (x, y) that link. Sets travel to their leader; a leader with many of them is copied to several tasks."""
    salts = pairs.groupBy("other").agg(F.ceil(F.count("*") / group).cast("int").alias("salts"))
    own = pairs.join(salts, "other").join(sets, "node").select("other", F.pmod(F.xxhash64("node", F.lit(5)), F.col("salts")).cast("int").alias("salt"), "node", "tokens")
    lead = salts.join(sets, salts["other"] == sets["node"]).select("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "node", "tokens")

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        is_lead = (pdf["node"] == pdf["other"]).to_numpy()
        lead = np.frombuffer(pdf["tokens"][int(np.flatnonzero(is_lead)[0])], np.uint64)
        first = {o: np.sort(prefix_of(lead, o, _size(lead, percent))) for o in ("B", "C")}
        out = []
        for node, raw in zip(pdf["node"][~is_lead], pdf["tokens"][~is_lead]):
            x = np.frombuffer(raw, np.uint64)
            if all(_meet(prefix_of(x, o, _size(x, percent)), first[o]) for o in ("B", "C")):
                both = int(np.count_nonzero(lead[np.minimum(np.searchsorted(lead, x), len(lead) - 1)] == x))
                if 100 * both >= percent * (len(x) + len(lead) - both):
                    out.append(node)
        return pd.DataFrame({"x": np.array(out, np.int64), "y": np.full(len(out), pdf["other"].iloc[0], np.int64)})

    return own.union(lead).groupBy("other", "salt").applyInPandas(test, "x long, y long")


def _size(x: np.ndarray, percent: int) -> int:
    return int(len(x) - least_overlap(np.int64(len(x)), percent) + 1)


def _meet(a: np.ndarray, b: np.ndarray) -> bool:
    return bool((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).any())


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows, with all their columns, of the least id of each component.

    Rows without an id can't be named by the result and all stay. Rows that share an id
    are one document: the one whose text sorts first stays.
    """
    from pyspark.sql import Window

    found = blocks.cut(near_duplicates(docs, words, percent, text, doc_id))
    own = "_" * (1 + max(map(len, docs.columns)))  # no column of docs is called so
    stay = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias(own)).withColumnRenamed("doc_id", own + "id")
    named = docs.join(stay, docs[doc_id] == stay[own + "id"])
    several = stay.where(stay[own] > 1).limit(1).count() > 0
    out = (named.where(stay[own] == 1) if several else named).select(*[docs[c] for c in docs.columns])
    if several:
        place = F.row_number().over(Window.partitionBy(own + "id").orderBy(docs[text]))
        out = out.union(named.where(stay[own] > 1).withColumn(own + "place", place).where(F.col(own + "place") == 1).select(*[docs[c] for c in docs.columns]))
    return out.union(docs.where(docs[doc_id].isNull()))
