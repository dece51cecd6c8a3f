"""How sources of a language differ in their words: exact document frequencies, then a recount into perfect-hash slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.perfect_hash import PerfectHash, packed, string_hashes
from lendscope.llm.tables import written
from lendscope.llm.words import chunks, text_bytes

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE_STEPS = 3  # digits to the base 1,000: a share is told in steps of 1e-9
TOP = 50
CHUNK = 4 << 20
SHARD_TERMS = 1 << 13
SHARD_CELLS = 1 << 20  # sources x terms of a shard, at most (one term at least)
BROADCAST_BYTES = 64 << 20  # of perfect hashes at a time; more take further passes over the texts
COUNTERS = 8 << 20  # dense slots that a task holds before it sends their counts

_IS_TERM = np.ones(256, bool)
_IS_TERM[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of each text, A-Z lower-cased, as one array of strings, and the number of terms of each text.

    A term is a run of ASCII letters and of bytes beyond ASCII, so characters beyond ASCII stay whole.
    """
    data, offsets = text_bytes(column)
    inside = _IS_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    return packed(lengths, _LOWER[data[inside]]), np.diff(np.searchsorted(starts, offsets))


def _coded(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of a batch, the code of each occurrence, and its document's number."""
    terms, sizes = split_terms(part.column("text"))
    encoded = terms.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _names(column: pa.Array) -> tuple[list[str], np.ndarray]:
    encoded = column.dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents of a run of text that hold a term."""
    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            terms, codes, document = _coded(part)
            if not len(codes):
                continue
            langs, lang = _names(part.column("lang"))
            pairs = np.unique(document * len(terms) + codes)
            found, n = np.unique(lang[pairs // len(terms)] * len(terms) + pairs % len(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()).take(pa.array(found // len(terms))),
                 terms.take(pa.array(found % len(terms))).cast(pa.large_string()).cast(pa.string()), pa.array(n)],
                names=["lang", "term", "n"])


def _hashed(table: pa.Table) -> pa.Table:
    """A shard's terms as a perfect hash."""
    terms = table.column("term").combine_chunks().cast(pa.large_string()).cast(pa.large_binary())
    return pa.table({"lang": table.column("lang")[:1].cast(pa.string()), "shard": table.column("shard")[:1],
                     "terms": pa.array([len(terms)], pa.int64()), "blob": pa.array([PerfectHash.build(terms).dump()], pa.binary())})


def _with_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            terms = batch.column("term").cast(pa.large_string()).cast(pa.large_binary())
            shard = string_hashes(terms, 999) % batch.column("shards").to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(shard.astype(np.int64)), batch.column("term")],
                                             names=["lang", "shard", "term"])


class _Slots:
    """Dense slots of the shards of one language that a pass has."""

    def __init__(self, shards: int, hashes: dict[int, PerfectHash]):
        self.shards, self.hashes = shards, hashes
        self.numbers = np.array(sorted(hashes), np.int64)
        sizes = [len(hashes[s].keys) for s in self.numbers.tolist()]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def find(self, terms: pa.Array) -> np.ndarray:
        out = np.full(len(terms), -1, np.int64)
        shard = (string_hashes(terms, 999) % np.uint64(self.shards)).astype(np.int64)
        for first, number in zip(self.first, self.numbers.tolist(), strict=False):
            rows = np.flatnonzero(shard == number)
            slot = self.hashes[number].find(terms.take(pa.array(rows)))
            out[rows[slot >= 0]] = first + slot[slot >= 0]
        return out


def _recount(shared, most: int):
    """Adds the terms of all texts up in slots per group. ``shared`` is a broadcast list of (lang, shards, shard, blob)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[int, dict[int, PerfectHash]]] = {}
        for name, shards, shard, blob in shared.value:
            found.setdefault(name, (shards, {}))[1][shard] = PerfectHash.load(blob)
        slots = {name: _Slots(*x) for name, x in found.items()}
        counters: dict[tuple[str, str], np.ndarray] = {}
        cells = 0

        def send() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in counters.items():
                at = np.flatnonzero(counts)
                shard = np.searchsorted(slots[lang].first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(at), np.int64))),
                     pa.array([source], pa.string()).take(pa.array(np.zeros(len(at), np.int64))),
                     pa.array(slots[lang].numbers[shard]), pa.array(at - slots[lang].first[shard]), pa.array(counts[at])],
                    names=["lang", "source", "shard", "slot", "n"])

        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                terms, codes, document = _coded(part)
                langs, lang = _names(part.column("lang"))
                sources, source = _names(part.column("source"))
                for number, name in enumerate(langs):
                    if name not in slots:
                        continue
                    own = lang[document] == number
                    here = codes[own]
                    used = np.unique(here)
                    slot = np.full(len(terms), -1, np.int64)
                    slot[used] = slots[name].find(terms.take(pa.array(used)))
                    width = int(slots[name].first[-1])
                    kept = slot[here] >= 0
                    key, n = np.unique(source[document[own][kept]].astype(np.int64) * width + slot[here][kept], return_counts=True)
                    cuts = np.flatnonzero(np.diff(key // max(width, 1), prepend=-1))
                    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True):
                        group = (name, sources[int(key[a]) // width])
                        if group not in counters:
                            if counters and cells + width > most:
                                yield from send()
                                counters.clear()
                                cells = 0
                            counters[group] = np.zeros(width, np.int64)
                            cells += width
                        counters[group][key[a:b] % width] += n[a:b]
        yield from send()

    return count


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(1000000000 * (count + 5) / (total + 5 * terms)) by long division, exact below 9e15 occurrences."""
    whole = np.int64(total + SMOOTHING * terms)
    rest, out = counts.astype(np.int64) + SMOOTHING, np.zeros(counts.shape, np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest %= whole
    return out + 1


def _compare(top: int):
    """Differences of all groups of a language over one shard's terms."""

    def compare(cells: pa.Table, hashes: pa.Table) -> pa.Table:
        lang = cells.column("lang")[0].as_py()
        columns = {c: cells.column(c).to_numpy() for c in ("slot", "n", "terms")}
        names, code = _names(cells.column("source").combine_chunks())
        marks = columns["slot"] < 0
        totals = np.zeros(len(names), np.int64)
        totals[code[marks]] = columns["n"][marks]
        order = np.argsort(np.array([x.encode() for x in names], object), kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        names, totals = [names[i] for i in order.tolist()], totals[order]
        keys = PerfectHash.load(hashes.column("blob")[0].as_py()).keys.to_pylist() if hashes.num_rows else []
        dense = np.zeros((len(names), len(keys)), np.int64)
        dense[place[code[~marks]], columns["slot"][~marks]] = columns["n"][~marks]
        terms = int(columns["terms"][0])
        p = np.stack([shares(row, int(n), terms) for row, n in zip(dense, totals, strict=True)]) if keys else dense
        out = {"source": [], "part": [], "item": [], "value": []}

        def put(source: str, part: str, items: list[str], values: list[int]) -> None:
            for k, v in (("source", [source] * len(items)), ("part", [part] * len(items)), ("item", items), ("value", values)):
                out[k].extend(v)

        for i, source in enumerate(names):
            put(source, "pair", names[i + 1 :], np.abs(p[i + 1 :] - p[i]).sum(axis=1).tolist())
        if keys:
            q = shares(dense.sum(axis=0), int(totals.sum()), terms)
            rank = np.empty(len(keys), np.int64)
            rank[np.argsort(np.array(keys, object), kind="stable")] = np.arange(len(keys))
            for i, source in enumerate(names):
                over = np.flatnonzero((dense[i] > 0) & (p[i] > q))
                best = over[np.lexsort((rank[over], q[over] - p[i, over]))][:top]
                put(source, "term", [keys[k].decode() for k in best.tolist()], (p[i, best] - q[best]).tolist())
        return pa.table({"lang": pa.array([lang] * len(out["value"]), pa.string()), "source": pa.array(out["source"], pa.string()),
                         "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()),
                         "value": pa.array(out["value"], pa.int64())})

    return compare


def frequent_terms(texts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term) of the terms in at least ``least`` documents of a language, counted exactly."""
    counts = texts.select("lang", "text").mapInArrow(_frequencies, "lang string, term string, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def term_counts(texts: DataFrame, hashes: DataFrame, most_bytes: int = BROADCAST_BYTES, counters: int = COUNTERS) -> DataFrame:
    """(lang, source, shard, slot, n) of all terms that ``hashes`` (lang, shards, shard, terms, blob) hold.

    Perfect hashes are broadcast, no more than ``most_bytes`` at a time (one shard at least, which has a bounded number
    of terms); where they are more, the texts are read once for each such portion.
    """
    spark = texts.sparkSession
    sizes = hashes.select("lang", "shard", F.length("blob").alias("size")).orderBy("lang", "shard").collect()
    portions: list[list] = []
    held = 0
    for row in sizes:
        if not portions or held + row["size"] > most_bytes:
            portions.append([])
            held = 0
        portions[-1].append(row)
        held += row["size"]
    schema = "lang string, source string, shard long, slot long, n long"
    counted = spark.createDataFrame([], schema)
    for portion in portions:
        low, high = portion[0], portion[-1]
        lang, shard = F.col("lang"), F.col("shard")
        inside = hashes.where((lang > low["lang"]) | ((lang == low["lang"]) & (shard >= low["shard"])))
        inside = inside.where((lang < high["lang"]) | ((lang == high["lang"]) & (shard <= high["shard"])))
        shared = spark.sparkContext.broadcast([(r["lang"], r["shards"], r["shard"], bytes(r["blob"])) for r in inside.toLocalIterator()])
        counts = texts.mapInArrow(_recount(shared, counters), schema)
        counted = counted.union(written(counts.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))))
    return counted


def source_divergence(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, shard_terms: int = SHARD_TERMS,
                      shard_cells: int = SHARD_CELLS, most_bytes: int = BROADCAST_BYTES, counters: int = COUNTERS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language are apart, and by which terms.

    ``documents`` has (text, lang, source); nulls count as ''. Terms are runs of ASCII letters and characters beyond
    ASCII, A-Z lower-cased. A language keeps its V terms that ``least`` of its documents or more hold; rows count as
    documents, repeated ones too. Each group (lang, source) and each language gives each kept term a share
    p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N the count's sum over kept terms, in whole numbers.
    Part ``pair``: for each other source of the language, the sum of the differences of shares over all kept terms (0
    if there is none). Part ``term``: of the terms that the group holds and gives a larger share than its language
    does, the ``top`` ones. Ranks go by value downwards, then by the item's bytes. Sources without any term take
    part; a language with one source has no pairs; an empty table gives no rows. Texts of any length are read whole, a
    run of CHUNK bytes (one text at least) at a time, and other columns are not read.

    1. Tasks count the documents of each term, a run of text at a time; sums are exact, then rare terms go.
    2. A language's kept terms are cut into shards by hash, small enough that sources x terms of a shard fit one task.
       A minimal perfect hash of each shard is built in a task, with its terms stored.
    3. The hashes are broadcast in portions of bounded size. The texts are read again: a term found, and equal
       to the stored one, adds to its slot in the dense counters of its group.
    4. Each (language, shard) compares all its groups; only sums per pair and the best ``top`` terms leave it.
    """
    texts = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    groups = written(texts.groupBy("lang", "source").agg(F.count("*").alias("documents")))
    terms = written(frequent_terms(texts, least))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(
        terms.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0).cast("long")))
    each = F.least(F.lit(shard_terms), F.greatest(F.lit(1), F.floor(shard_cells / F.col("sources"))))
    langs = written(langs.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("terms") / each)).cast("long")))
    sharded = terms.join(langs.select("lang", "shards"), "lang").select("lang", "term", "shards").mapInArrow(
        _with_shards, "lang string, shard long, term string")
    hashes = sharded.groupBy("lang", "shard").applyInArrow(_hashed, "lang string, shard long, terms long, blob binary")
    hashes = written(hashes.join(langs.select("lang", "shards"), "lang").select("lang", "shards", "shard", "terms", "blob"))

    counts = term_counts(texts, hashes, most_bytes, counters)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    marks = groups.join(totals, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
        F.lit(-1).cast("long").alias("slot"), F.coalesce("n", F.lit(0).cast("long")).alias("n"), "terms")
    cells = counts.join(langs.select("lang", "terms"), "lang").select("lang", "source", "shard", "slot", "n", "terms").union(marks)
    parts = cells.groupBy("lang", "shard").cogroup(hashes.select("lang", "shard", "blob").groupBy("lang", "shard")).applyInArrow(
        _compare(top), "lang string, source string, part string, item string, value long")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.union(parts.where("part = 'term'").select("lang", "source", "part", "item", "value")).withColumn("rank", rank)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
