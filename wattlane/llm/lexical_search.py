"""Ranked lexical search by dense blocked matrix products.

Queries ("items") are taken in tiles of bounded size. The vocabulary of a tile is compact:
only its own terms get a number. One map turns each document into its term count and its
postings over that vocabulary, which are written once; corpus statistics are sums over
them. A second map cuts the documents into tiles and multiplies, vocabulary block by
vocabulary block, the weights (items x terms) by the dense impacts (terms x documents) in
float64. A block never holds more weight per item than keeps its sums below 2^53, so each
product is an exact integer; blocks are added as 64-bit integers. Every tile is folded at
once into the best rows of its task, ties included, so a task sends at most ``top`` rows
an item and the last step ranks those.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattlane.llm.common import col, documents, query
from wattlane.session import settle

#: Bounds of a tile of items: rows, and bytes of their texts.
ITEMS = 256
ITEM_BYTES = 1 << 20
#: Documents of a tile, and terms of a block of the vocabulary.
DOCS = 1024
TERMS = 1024
#: No impact reaches this, and no sum of a block may reach the other.
IMPACT = 1_000_000
EXACT = 1 << 53

#: Bytes of a term stay, A-Z in lower case; every other byte parts terms.
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and anything beyond ASCII, in order."""
    return text.encode().translate(KEPT).split() if text else []


def _tiles(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items, one tile at a time on the driver."""
    tile, size = [], 0
    for item, text in items.select(col(id_col), col(text_col)).toLocalIterator():
        tile.append((item, text))
        size += len(text or "")
        if len(tile) >= ITEMS or size >= ITEM_BYTES:
            yield tile
            tile, size = [], 0
    if tile:
        yield tile


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def blocks(weights: np.ndarray, times: np.ndarray, item: np.ndarray, term: np.ndarray, n_items: int, most: int = TERMS):
    """Cuts the entries (item, term, times) into blocks ``(terms, matrix)`` of at most ``most``
    terms, in each of which no item's weights can add up to 2^53 with the largest impact.
    A term repeated so often in an item that it alone would passes that on to further blocks."""
    room = (EXACT - 1) // IMPACT
    out = []
    left = times.astype(np.int64).copy()
    while True:
        open_ = np.flatnonzero((left > 0) & (weights[term] > 0))
        if not len(open_):
            return out
        used = np.zeros(n_items, np.int64)
        columns: dict[int, int] = {}
        taken = []
        for e in open_:  # entries lie in the order of their terms
            t = int(term[e])
            if t not in columns and len(columns) == most:
                break
            n = min(int(left[e]), int(room - used[item[e]]) // int(weights[t]))
            if n:
                columns.setdefault(t, len(columns))
                used[item[e]] += n * int(weights[t])
                left[e] -= n
                taken.append((item[e], columns[t], n * int(weights[t])))
        matrix = np.zeros((n_items, len(columns)))
        for i, c, w in taken:
            matrix[i, c] += w
        out.append((np.array(list(columns), np.int64), matrix))


def _postings(batches, vocabulary, id_type):
    """A row per document: id, number of terms, terms of the vocabulary and how often they occur."""
    known = vocabulary.value.get
    for batch in batches:
        counts, ends, flat, often = [], [0], [], []
        for text in batch.column(1).to_pylist():
            found = terms(text)
            here = Counter(map(known, found))
            here.pop(None, None)
            counts.append(len(found))
            flat.extend(here)
            often.extend(here.values())
            ends.append(len(flat))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(often, pa.int64()))], ["id", "n", "terms", "times"])


def best_rows(found: pa.Table, top: int) -> pa.Table:
    """Of each item the ``top`` rows of highest score, equal scores by ascending id, null last."""
    found = found.sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    item = found.column("item").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(item)))
    return found.filter(pa.array(np.arange(len(item)) - np.repeat(starts, sizes) < top))


def score_tile(ids: pa.Array, n: list, ends: np.ndarray, flat: np.ndarray, often: np.ndarray, parts: list, n_items: int,
               n_docs: int, n_terms: int, vocabulary: int) -> np.ndarray:
    """Scores, items x documents, as 64-bit integers."""
    m = np.array([75 + (25 * x * n_docs) // n_terms for x in n], np.int64)
    doc = np.repeat(np.arange(len(n)), np.diff(ends))
    impact = (1_000_000_000 * often) // (1000 * often + 12 * m[doc])
    scores = np.zeros((n_items, len(n)), np.int64)
    column = np.full(vocabulary, -1)
    for block_terms, matrix in parts:
        column[:] = -1
        column[block_terms] = np.arange(len(block_terms))
        at = column[flat]
        here = np.flatnonzero(at >= 0)
        if not len(here):
            continue
        dense = np.zeros((len(block_terms), len(n)))
        dense[at[here], doc[here]] = impact[here]
        scores += (matrix @ dense).astype(np.int64)
    return scores


def _search(batches, model, top, id_type):
    parts, item_ids, n_docs, n_terms, vocabulary = model.value
    n_items = len(item_ids)
    best, floor = None, np.ones(n_items, np.int64)
    for batch in (b.slice(i, DOCS) for b in batches for i in range(0, b.num_rows, DOCS)):
        flat, lists = batch.column(2).flatten().to_numpy(), batch.column(2)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        scores = score_tile(batch.column(0), batch.column(1).to_pylist(), ends, flat,
                            batch.column(3).flatten().to_numpy(), parts, n_items, n_docs, n_terms, vocabulary)
        if scores.shape[1] > top:
            floor_here = np.maximum(floor, np.partition(scores, -top, axis=1)[:, -top])
        else:
            floor_here = floor
        item, doc = np.nonzero(scores >= floor_here[:, None])
        if not len(item):
            continue
        found = pa.table({"item": pa.array(item.astype(np.int32)), "score": pa.array(scores[item, doc]),
                          "id": batch.column(0).take(pa.array(doc))})
        best = best_rows(found if best is None else pa.concat_tables([best, found]), top)
        kept = best.column("item").to_numpy()
        last = np.bincount(kept, minlength=n_items)
        full = np.flatnonzero(last >= top)  # a row below the last of a full list can't enter it any more
        floor[full] = best.column("score").to_numpy()[np.cumsum(last)[full] - 1]
    if best is not None:
        for b in best.to_batches():
            yield b


def lexical_search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_col, rank, id_col, score``: of each row of ``items`` the ``top`` documents with the
    highest score above 0, equal scores by ascending id. Ranks run from 1 without gaps.

    A document's score sums, over the item's terms with their repeats, the term's weight
    floor(1000 ln((2N+2)/(2df+1))) times the integer impact 10^9 tf div (1000 tf + 12 m), where
    m = 75 + 25 n N div L; N counts the documents with a term, L their terms.

    Null or empty texts have no term: such documents are found by no item, and such items find
    none. Rows that repeat an id, even wholly, are documents or items of their own; null ids
    rank after known ones of the same score. An empty table on either side gives an empty
    result; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    posting = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                            T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.LongType()))])
    found_row = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("id", id_type)])
    row = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                        T.StructField("id", id_type), T.StructField("score", T.LongType())])
    results = []
    for tile in _tiles(items, item_col, item_text_col):
        entries = [Counter(terms(text)) for _, text in tile]
        numbers = {t: i for i, t in enumerate(sorted({t for e in entries for t in e}))}
        if not numbers:
            continue
        vocabulary = spark.sparkContext.broadcast(numbers)  # the terms of one tile, at most ITEM_BYTES and one item
        staged = settle(texts.mapInArrow(lambda b, v=vocabulary: _postings(b, v, id_type), posting), "postings")
        n_docs, n_terms = staged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(numbers), np.int64)
        for t, c in staged.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[t] = c  # a row per term of the tile
        triples = sorted((numbers[t], i, c) for i, e in enumerate(entries) for t, c in e.items())
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        term, item, times = (np.array(x, np.int64) for x in zip(*triples))
        model = spark.sparkContext.broadcast((blocks(weights, times, item, term, len(tile)), [i for i, _ in tile],
                                              n_docs, n_terms, len(numbers)))
        found = staged.mapInArrow(lambda b, m=model: _search(b, m, top, id_type), found_row)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = settle(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "ranked")
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(tile)], T.StructType(
            [T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
        results.append(ranked.join(names, "item").select("item_id", "rank", "id", "score"))
    out = results[0] if results else spark.createDataFrame([], row)
    for more in results[1:]:
        out = out.union(more)
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


@query("op13_lexical_search", r"""
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
    asked AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM postings, total GROUP BY term),
    scored AS (
        SELECT item_id, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), total
        GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20""")
def op13_lexical_search(spark, sf_dir):
    return lexical_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
