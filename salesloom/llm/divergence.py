"""Audit of how the sources of a language differ in their terms, by in-mapper stripes.

A partition folds its documents into one stripe per term of a language: in how many documents it occurs, and how
often in each source. Stripes are spilled before they outgrow a bound, merged by key, and the merged ones give
each source's divergence from every other source and the terms that set it apart from its language.

Shares are whole billionths and all sums are of whole numbers, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.functions.columns import q
from salesloom.llm.bytewords import byte_table
from salesloom.llm.common import small_batches, table
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

#: Terms are runs of letters and all that is beyond ASCII.
TABLE = byte_table(lambda b: b >= 0x80 or 0x61 <= b <= 0x7A)
#: A term counts in a language if so many of its documents have it.
MIN_DOCS = 10
#: Terms reported per source.
TOP_TERMS = 10
#: Bytes of text that a task folds at once, and cells of stripes it holds before it spills them.
CHUNK_BYTES = 24 << 20
HOLD_CELLS = 3_000_000
_SPILL_ROWS, _WINDOW_ROWS = 10_000, 50_000
#: Cells (a term's count in a source) of a language that are worked on at once, and cells of a matrix of sources.
LEAST_CELLS, MOST_CELLS = 1 << 14, 1 << 22

_STRIPES = "lang string, term binary, docs long, sources array<string>, counts array<long>"


class _Cells(NamedTuple):
    """Stripes as flat cells in (term, language, source) order; ``term`` numbers ``terms``."""

    terms: pa.Array
    term: np.ndarray
    lang: np.ndarray
    source: np.ndarray
    docs: np.ndarray
    count: np.ndarray


class _Names:
    """Numbers for the names a task has met."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, name: str) -> int:
        return self.known.setdefault(name, len(self.known))

    def spelled(self, numbers: np.ndarray) -> pa.Array:
        return pa.array(list(self.known), pa.string()).take(pa.array(numbers))


def _hash_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each text's words among them, and its text's place."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    filled = data != 0x20
    steps = np.diff(filled.astype(np.int8), prepend=0)
    begins, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - begins)])
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[filled])]
    found = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    place = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begins, starts)))
    return found.dictionary, found.indices.to_numpy().astype(np.int64), place


def _fold_chunk(docs: list[tuple[int, int, bytes]]) -> _Cells:
    """(language, source, bare text) of whole documents to cells. The empty term stands for the documents."""
    docs = sorted(docs, key=lambda d: d[:2])  # so that words sorted by term and document are in cell order
    lang, source = (np.array([d[i] for d in docs], np.int64) for i in (0, 1))
    terms, word, place = _hash_words([d[2] for d in docs])
    terms = pa.concat_arrays([terms, pa.array([b""], pa.binary())])
    word = np.concatenate([word, np.full(len(docs), len(terms) - 1)])
    pairs = word * len(docs) + np.concatenate([place, np.arange(len(docs))])
    pairs.sort()
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    word, place = np.divmod(pairs[first], len(docs))
    often = np.diff(first, append=len(pairs))
    return _added(terms, word, lang[place], source[place], np.ones(len(word), np.int64), often)


def _added(terms, term, lang, source, docs, count) -> _Cells:
    """Equal cells that follow each other are added up."""
    new = np.ones(len(term), bool)
    new[1:] = (np.diff(term) != 0) | (np.diff(lang) != 0) | (np.diff(source) != 0)
    first = np.flatnonzero(new)
    sums = (np.add.reduceat(x, first) if len(first) else x for x in (docs, count))
    return _Cells(terms, term[first], lang[first], source[first], *sums)


def _combine(held: list[_Cells]) -> _Cells:
    """Cells of several chunks as those of one."""
    if len(held) == 1:
        return held[0]
    found = pa.concat_arrays([c.terms for c in held]).dictionary_encode()
    number = found.indices.to_numpy().astype(np.int64)
    before = np.cumsum([0, *(len(c.terms) for c in held)])
    term = np.concatenate([number[b + c.term] for b, c in zip(before, held)])
    rest = [np.concatenate([getattr(c, name) for c in held]) for name in _Cells._fields[2:]]
    order = np.lexsort((rest[1], rest[0], term))
    return _added(found.dictionary, term[order], *(x[order] for x in rest))


def _spill(cells: _Cells, langs: _Names, sources: _Names) -> Iterator[pa.RecordBatch]:
    """One row per stripe."""
    new = np.ones(len(cells.term), bool)
    new[1:] = (np.diff(cells.term) != 0) | (np.diff(cells.lang) != 0)
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(cells.term))
    docs = np.add.reduceat(cells.docs, begins) if len(begins) else cells.docs
    for at in range(0, len(begins), _SPILL_ROWS):
        some = slice(at, at + _SPILL_ROWS)
        cut = slice(begins[at], ends[some][-1])
        yield _rows(
            langs.spelled(cells.lang[begins[some]]), cells.terms.take(pa.array(cells.term[begins[some]])), docs[some],
            np.append(begins[some], ends[some][-1]) - begins[at], sources.spelled(cells.source[cut]), cells.count[cut],
        )


def _rows(langs, terms, docs, offsets, sources, counts) -> pa.RecordBatch:
    where = pa.array(offsets, pa.int32())
    return pa.record_batch(
        {
            "lang": langs, "term": terms, "docs": pa.array(docs, pa.int64()),
            "sources": pa.ListArray.from_arrays(where, sources),
            "counts": pa.ListArray.from_arrays(where, pa.array(counts, pa.int64())),
        }
    )


def _fold(chunk_bytes: int, hold_cells: int) -> Callable:
    """Documents to stripes, held by a task across its chunks and spilled beyond ``hold_cells``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, sources = _Names(), _Names()
        docs: list[tuple[int, int, bytes]] = []
        held: list[_Cells] = []
        size = 0
        for batch in batches:
            columns = batch["_lang"].to_pylist(), batch["_source"].to_pylist(), batch["_text"]
            for lang, source, text in zip(*columns):
                bare = (text.as_py() or b"").translate(TABLE)
                docs.append((langs(lang), sources(source), bare))
                size += len(bare) + 1
                if size > chunk_bytes:
                    held.append(_fold_chunk(docs))
                    docs, size = [], 0
                    if len(held) > 1 and sum(len(c.term) for c in held) > hold_cells:
                        held = [_combine(held)]
                        if len(held[0].term) > hold_cells // 2:
                            yield from _spill(held.pop(), langs, sources)
        if docs:
            held.append(_fold_chunk(docs))
        if held:
            yield from _spill(_combine(held), langs, sources)

    return run


def _merge(min_docs: int) -> Callable:
    """Stripes sorted by key to one stripe a key, those of frequent terms and of the documents.

    Rows are taken in windows; the last key of a window goes on in the next one as a single row.
    """

    def window(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.RecordBatch | None]:
        rows = rows.combine_chunks()
        lang, term = rows["lang"].combine_chunks(), rows["term"].combine_chunks()
        n, new = len(rows), np.ones(len(rows), bool)
        for key in (lang, term):
            unlike = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = unlike if key is lang else new[1:] | unlike
        begins, group = np.flatnonzero(new), np.cumsum(new) - 1
        docs = np.add.reduceat(rows["docs"].to_numpy(), begins)
        keep = docs >= min_docs
        keep |= pc.binary_length(term).to_numpy(zero_copy_only=False)[begins] == 0
        if not last:
            keep[-1] = True
        some = rows.filter(pa.array(keep[group]))
        if not len(some):
            return None, None
        number = np.cumsum(keep) - 1
        lengths = pc.list_value_length(some["counts"]).to_numpy()
        owner = np.repeat(number[group[keep[group]]], lengths)
        found = pc.list_flatten(some["sources"]).combine_chunks().dictionary_encode()
        cell = owner * max(1, len(found.dictionary)) + found.indices.to_numpy()
        order = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.diff(cell[order], prepend=-1))
        counts = np.add.reduceat(pc.list_flatten(some["counts"]).to_numpy()[order], first)
        owner = owner[order][first]
        offsets = np.searchsorted(owner, np.arange(keep.sum() + 1))
        rest = pa.array(begins[keep])
        names = found.dictionary.take(found.indices.take(pa.array(order[first])))
        out = _rows(lang.take(rest), term.take(rest), docs[keep], offsets, names, counts)
        return (out, None) if last else (out.slice(0, len(out) - 1), out.slice(len(out) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _WINDOW_ROWS:
                done, open_ = window(pa.Table.from_batches([_plain(b) for b in held]), last=False)
                held = [open_]
                yield done
        held = [_plain(b) for b in held if b.num_rows]
        if held:
            done, _ = window(pa.Table.from_batches(held), last=True)
            if done is not None:
                yield done

    return run


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The columns alone: field properties differ between what Spark sends and what is made here."""
    return pa.record_batch([c.cast(t) for c, t in zip(batch.columns, _KINDS)], names=["lang", "term", "docs", "sources", "counts"])


_KINDS = (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))


def stripes(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, chunk_bytes: int = CHUNK_BYTES, hold_cells: int = HOLD_CELLS,
) -> DataFrame:
    """``lang, term, docs, sources, counts``: merged stripes, landed.

    Terms that at least ``min_docs`` documents of the language have, and one stripe with an empty term per
    language, which counts documents. A task folds ``chunk_bytes`` of text at once, and at least one document, and holds
    about ``hold_cells`` cells before it spills; a term in all documents arrives as one row per spill of a task.
    """

    def plain(name: str) -> Column:
        return F.coalesce(q(name).cast("string"), F.lit(""))

    small_batches(docs.sparkSession)
    folded = docs.select(
        plain(lang).alias("_lang"), plain(source).alias("_source"),
        q(text).cast("string").cast("binary").alias("_text"),
    ).mapInArrow(_fold(chunk_bytes, hold_cells), _STRIPES)
    dealt = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return land(dealt.mapInArrow(_merge(min_docs), _STRIPES), "stripes")


def share(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """``1 + floor(1e9 * (count + 2) / total)``, exact in 64 bits by three steps of a long division."""
    whole, rest = np.divmod(np.asarray(counts, np.int64) + 2, totals)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + digit
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))``; shares are below 2**30 and a bit, so squares fit."""
    return (p - q) ** 2 // (p + q)


def _diverge(top: int, most_cells: int) -> Callable:
    """One part of a language's stripes and all its sources to partial divergences.

    A term that neither of two sources has adds the same to all such pairs, so only cells that occur are
    visited: with z the share of a source for a count of zero, a pair's sum is that of f(z, z) over all terms,
    plus f(p, z) - f(z, z) where one has the term, plus what is left where both have it.
    """

    def run(cells: pa.Table, sources: pa.Table) -> pa.Table:
        out: list[tuple] = []
        sources = sources.sort_by("source")
        names, sums = sources["source"].to_pylist(), sources["total"].to_numpy()
        lang, part, block = (sources[c][0].as_py() for c in ("lang", "part", "block"))
        n_terms = sources["terms"][0].as_py()
        wide = max(1, most_cells // len(names))
        mine = np.arange(block * wide, min((block + 1) * wide, len(names)))
        pairs = np.zeros((len(mine), len(names)), np.int64)
        if n_terms:
            zeros = share(np.zeros(len(names), np.int64), sums + 2 * n_terms)
            apart = distance(zeros[mine][:, None], zeros[None, :])
            if part == 0:
                pairs += n_terms * apart
        if len(cells):
            cells = cells.sort_by("term")
            place = {name: i for i, name in enumerate(names)}
            lengths = pc.list_value_length(cells["counts"]).to_numpy()
            who = np.array([place[s] for s in pc.list_flatten(cells["sources"]).to_pylist()], np.int64)
            counts = pc.list_flatten(cells["counts"]).to_numpy()
            term = np.repeat(np.arange(len(cells)), lengths)
            p = share(counts, (sums + 2 * n_terms)[who])
            own = (who >= mine[0]) & (who <= mine[-1])
            _one_sided(pairs, who, p, zeros, mine, apart)
            ends = np.cumsum(lengths)
            for begin, end in zip(ends - lengths, ends):
                s, x, here = who[begin:end], p[begin:end], own[begin:end]
                rows = s[here] - mine[0]
                if len(rows) and len(s) > 1:
                    a, b, za, zb = x[here][:, None], x[None, :], zeros[s[here]][:, None], zeros[s][None, :]
                    pairs[np.ix_(rows, s)] += (
                        distance(a, b) - distance(a, zb) - distance(za, b) + distance(za, zb)
                    )
            whole = np.add.reduceat(counts, ends - lengths) if len(ends) else counts
            common = share(whole, int(sums.sum()) + 2 * n_terms)[term]
            picked = np.flatnonzero(own & (counts > 0) & (p > common))
            value = distance(p[picked], common[picked])
            order = np.lexsort((term[picked], -value, who[picked]))
            at = who[picked][order]
            first = np.searchsorted(at, at)  # where the rows of this source begin
            best = order[np.arange(len(order)) - first < top]
            spelled = cells["term"].to_pylist()
            for k in best:
                i = picked[k]
                out.append((names[who[i]], "term", spelled[term[i]].decode("utf-8", "replace"), int(value[k])))
        for i, row in zip(mine, pairs):
            out += [(names[i], "pair", names[j], int(v)) for j, v in enumerate(row) if j != i]
        made = list(zip(*out)) or [[], [], [], []]
        return pa.table(
            {
                "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(made[0], pa.string()),
                "part": pa.array(made[1], pa.string()), "item": pa.array(made[2], pa.string()),
                "value": pa.array(made[3], pa.int64()),
            }
        )

    return run


def _one_sided(pairs, who, p, zeros, mine, apart) -> None:
    """Adds f(p, z) - f(z, z) for each cell, from both sides of a pair; equal shares are taken together."""
    for s in np.unique(who):
        shares, often = np.unique(p[who == s], return_counts=True)
        for x, n in zip(shares, often):
            if mine[0] <= s <= mine[-1]:
                pairs[s - mine[0]] += n * (distance(x, zeros) - apart[s - mine[0]])
            pairs[:, s] += n * (distance(zeros[mine], x) - apart[:, s])


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP_TERMS, chunk_bytes: int = CHUNK_BYTES, hold_cells: int = HOLD_CELLS,
    least_cells: int = LEAST_CELLS, most_cells: int = MOST_CELLS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the divergence of a source from each other one of its language, summed over the
    language's frequent terms. Part ``term``: the ``top`` terms that are more frequent in a source than in its
    language. Ranks start at 1 in each part of a source, by value descending, then item by its UTF-8 bytes.

    A term is frequent if ``min_docs`` documents of the language have it; with no such terms all pairs have 0.
    NULL and empty texts have no terms; NULL languages and sources read as the empty text; repeated
    rows count as often as they occur; other columns are not looked at, so their names may be anything. An empty table gives an empty result. Whole texts count, whatever their length.

    A language's stripes are worked on in parts by a hash of the term, and the rows of its matrix of sources in blocks,
    so neither a language with a third of all rows nor one with very many sources is one group.
    """
    merged = stripes(docs, text, lang, source, min_docs, chunk_bytes, hold_cells)
    kept = merged.where(F.octet_length("term") > 0)
    cell = F.explode(F.arrays_zip("sources", "counts")).alias("_cell")

    def per_source(rows: DataFrame, name: str, value: Column) -> DataFrame:
        return (
            rows.select(F.col("lang").alias("lang"), cell)
            .groupBy("lang", F.col("_cell.sources").alias("source")).agg(value.alias(name))
        )

    groups = merged.where(F.octet_length("term") == 0).select("lang", cell).select("lang", F.col("_cell.sources").alias("source"))
    sums = per_source(kept, "total", F.sum("_cell.counts"))
    shape = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum(F.size("counts")).alias("cells")
    )
    wide = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    square = F.col("sources").cast("double") * F.col("sources")
    at_once = F.least(F.lit(float(most_cells)), F.greatest(F.lit(float(least_cells)), 4 * square))
    rows_a_block = F.greatest(F.lit(1), F.floor(F.lit(most_cells) / F.col("sources")))
    shape = land(
        wide.join(shape, "lang", "left").select(
            F.col("lang").alias("of_lang"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms"),
            F.greatest(F.lit(1), F.ceil(F.coalesce("cells", F.lit(0)) / at_once)).cast("int").alias("parts"),
            F.ceil(F.col("sources") / rows_a_block).cast("int").alias("blocks"),
        ),
        "languages",
    )
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    totals = land(
        groups.join(sums, ["lang", "source"], "left").select(
            "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total")
        ),
        "totals",
    )
    sides = lookup_join(totals, shape, [("lang", "of_lang")])
    sides = sides.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "lang", "part", block, "source", "total", "terms"
    )
    cells = lookup_join(kept, shape, [("lang", "of_lang")]).select(
        "lang", F.pmod(F.xxhash64("term"), "parts").cast("int").alias("part"), block, "term", "sources", "counts"
    )
    keys = ["lang", "part", "block"]
    partial = land(
        cells.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(
            _diverge(top, most_cells), "lang string, source string, part string, item string, value long"
        ),
        "divergences",
    )
    pairs = partial.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    both = pairs.unionByName(partial.where("part = 'term'"))
    ranked = both.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), words AS (
  SELECT i, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT i) >= 10
), sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (SELECT DISTINCT lang, source FROM docs
), totals AS (
  SELECT groups.lang, groups.source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM groups LEFT JOIN counts ON groups.lang = counts.lang AND groups.source = counts.source GROUP BY ALL
), shares AS (
  SELECT t.lang, t.source, kept.term, coalesce(n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
  FROM totals t JOIN kept ON t.lang = kept.lang JOIN sizes ON t.lang = sizes.lang
  LEFT JOIN counts ON counts.lang = t.lang AND counts.source = t.source AND counts.term = kept.term
), whole AS (
  SELECT c.lang, term, 1 + 1000000000::HUGEINT * (c.n + 2) // (total + 2 * v) AS p
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL) c
  JOIN (SELECT lang, sum(total)::HUGEINT AS total FROM totals GROUP BY lang) t ON c.lang = t.lang
  JOIN sizes ON c.lang = sizes.lang
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang AS l, x.source AS s, y.source AS o, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS f
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) ON a.lang = l AND a.source = s AND b.source = o
), terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (s.p - w.p) * (s.p - w.p) // (s.p + w.p) AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.n > 0 AND s.p > w.p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 10
"""
