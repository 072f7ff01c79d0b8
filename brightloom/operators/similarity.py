"""TF-IDF weights and cosine recommendations as joins over a long term table.

The catalogue is shuffled once, by id, as text, and the terms of a document are
counted where its text is. Only terms of the vocabulary are placed by id again, for
the norm. A query is a join on terms between the weights of a few liked rows and
the weights of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions import text
from brightloom.functions.words import ENGLISH_STOP_WORDS
from brightloom.operators.catalogue import matches_filters
from brightloom.session import written

# Words whose terms are counted together, and words of a piece of a document: rows go to Python 10,000 at a time.
WORDS_AT_ONCE = 200_000
PIECE_WORDS = 64
# Words an explanation never names.
IGNORED_WORDS = (
    "the", "and", "with", "from", "that", "this", "into", "movie",
    "film", "one", "new", "man", "woman", "story", "people",
)
NO_SHARED_TERMS = "Ranked by similarity across the available movie metadata."
SHARED_TERMS = "Shares metadata terms: "
UNKNOWN = "Unknown"


def place_by_id(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(id, tags) placed by id: the one shuffle of the texts.

    The number of parts is the session's where none is given, and is kept: a part
    of texts is many times its size once its terms are counted.
    """
    rows = docs.select("id", text.blank_if_null(F.col("tags")).alias("tags"))
    return rows.repartition(partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def _terms_of(words: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, term, how often) of the words and pairs of neighbours of every row, each term of a row once."""
    flat = words.flatten().dictionary_encode()
    code, names = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))

    def counted(row: np.ndarray, code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, often = np.unique(row * size + code, return_counts=True)
        return keys // size, keys % size, often

    one_row, one, one_often = counted(row, code, max(len(names), 1))
    beside = np.flatnonzero(row[1:] == row[:-1])
    pairs, pair = np.unique(code[beside] * max(len(names), 1) + code[beside + 1], return_inverse=True)
    two_row, two, two_often = counted(row[beside], pair, max(len(pairs), 1))
    first, second = (names.take(pa.array(at)) for at in np.divmod(pairs, max(len(names), 1)))
    both = pc.binary_join_element_wise(first, second, " ")
    terms = pa.concat_arrays([names.take(pa.array(one)), both.take(pa.array(two))])
    return np.concatenate([one_row, two_row]), terms, np.concatenate([one_often, two_often])


def _whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """(ids, words) of the documents whose last piece has come; pieces of a document follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if not pc.any(batch.column("last")).as_py():
            continue
        ids, pieces, last = pa.Table.from_batches(held).combine_chunks().columns
        pieces = pieces.combine_chunks()
        ends = np.flatnonzero(last.to_numpy()) + 1
        starts = np.cumsum(np.concatenate([[0], pc.list_value_length(pieces).to_numpy(zero_copy_only=False)]))
        offsets = pa.array(starts[np.concatenate([[0], ends])], pa.int32())
        yield ids.combine_chunks().take(pa.array(ends - 1)), pa.ListArray.from_arrays(offsets, pieces.flatten())
        rest = batch.slice(batch.num_rows - (len(last) - ends[-1]))
        held = [rest] if rest.num_rows else []


def _counted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, term, tf) of batches of (id, words, last), the pieces of documents, some documents at a time."""
    for ids, words in _whole_documents(batches):
        ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + WORDS_AT_ONCE, "right")))
            row, terms, often = _terms_of(words.slice(start, stop - start))
            columns = [ids.slice(start, stop - start).take(pa.array(row)), terms, pa.array(often, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "term", "tf"])
            start = stop


def term_counts(placed: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """(id, term, tf) of the words and word pairs in `tags`; pairs skip over stop words.

    Words have two letters or more. A document is counted by itself, so its terms
    are neither grouped nor kept; only where ids repeat are the counts of an id
    added up. Words go to Python in pieces, so that a batch of rows is as small where
    documents are long.
    """
    found = F.regexp_extract_all(F.lower(F.col("tags")), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    words = F.filter(found, lambda w: ~w.isin(list(stop_words))) if stop_words else found
    schema = f"id {placed.schema['id'].dataType.simpleString()}, term string, tf long"

    count = F.greatest(F.lit(1), F.ceil(F.size("_words") / PIECE_WORDS)).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), F.col("_pieces")), lambda i: F.slice("_words", (i - 1) * PIECE_WORDS + 1, F.lit(PIECE_WORDS)))

    def counted(rows: DataFrame) -> DataFrame:
        whole = rows.select("id", words.alias("_words")).withColumn("_pieces", count)
        cut = whole.select("id", "_pieces", F.posexplode(pieces).alias("_at", "words"))
        return cut.select("id", "words", (F.col("_at") + 1 == F.col("_pieces")).alias("last")).mapInArrow(_counted_rows, schema)

    # Looking at the text keeps both columns here, so the ids are counted on the exchange of the texts.
    rows_of_id = placed.groupBy("id").agg(F.count_if(F.length("tags") >= 0).alias("rows"))
    repeats = F.coalesce(rows_of_id.agg(F.max("rows") > 1).scalar(), F.lit(False))
    added = counted(placed.filter(repeats)).groupBy("id", "term").agg(F.sum("tf").alias("tf"))
    return counted(placed.filter(~repeats)).unionByName(added)


def vocabulary(counts: DataFrame, placed: DataFrame, max_features: int = 10_000, min_df: int = 1) -> DataFrame:
    """(term, df, total, idf) of the most frequent terms; equal counts go by term.

    idf is smoothed as if one more document held every term. Totals are merged
    per partition before the shuffle, and the cut is a top-k, not a sort.
    """
    # Looking at the text keeps both columns in this branch, so the documents are
    # counted on the exchange that the terms come from and not read again.
    n = placed.agg(F.count_if(F.length("tags") >= 0)).scalar()
    top = (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
        .filter(F.col("df") >= min_df)
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )
    return top.withColumn(
        "idf", F.ln((n + F.lit(1)).cast("double") / (F.col("df") + 1)) + F.lit(1.0)
    )


def weigh(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, term, weight): (1 + ln tf) * idf, scaled to length 1 per document."""
    raw = counts.join(terms.select("term", "idf"), "term").select(
        "id", "term", ((F.lit(1.0) + F.ln(F.col("tf").cast("double"))) * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.select("id", "term", (F.col("w") / norm).alias("weight"))


def tfidf(
    docs: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, max_features: int = 10_000, min_df: int = 1
) -> DataFrame:
    """Weights of every document (`id`, `tags`)."""
    placed = place_by_id(docs)
    counts = term_counts(placed, stop_words)
    return weigh(counts, vocabulary(counts, placed, max_features, min_df))


def title_index(catalogue: DataFrame) -> DataFrame:
    """(title_key, id): the last row of each normalised title."""
    return (
        catalogue.select(text.normalize_title(F.col("title")).alias("title_key"), F.col("movie_id"))
        .groupBy("title_key")
        .agg(F.max("movie_id").alias("source_id"))
    )


def resolve_titles(catalogue: DataFrame, liked: DataFrame) -> DataFrame:
    """(title, source_id) of the liked titles that the catalogue has."""
    keyed = liked.select("title", text.normalize_title(F.col("title")).alias("title_key"))
    return keyed.join(title_index(catalogue), "title_key").select("title", "source_id")


def unknown_titles(catalogue: DataFrame, liked: DataFrame) -> DataFrame:
    """Liked titles that the catalogue does not have."""
    keyed = liked.withColumn("title_key", text.normalize_title(F.col("title")))
    return keyed.join(title_index(catalogue), "title_key", "left_anti").drop("title_key")


def similarities(queries: DataFrame, weights: DataFrame) -> DataFrame:
    """(source_id, movie_id, similarity) for every row that shares a term with a source.

    Similarity is the dot product of unit vectors. Only the terms of the sources
    are joined. They are stored first: a table on disk has a known size, so Spark
    broadcasts it where it is small, leaves the weights in place then, and splits
    hot terms otherwise.
    """
    asked = queries.select(F.col("source_id").alias("id")).distinct().join(weights, "id")
    asked = written(asked.select(F.col("id").alias("source_id"), "term", F.col("weight").alias("_query_weight")), "asked")
    return (
        asked.join(weights, "term")
        .filter(F.col("id") != F.col("source_id"))
        .groupBy("source_id", F.col("id").alias("movie_id"))
        # Rounded so that exact copies tie whatever order their terms were added in.
        .agg(F.round(F.sum(F.col("_query_weight") * F.col("weight")), 12).alias("similarity"))
    )


def _best_per_title(ranked: DataFrame, n: int) -> DataFrame:
    """Best row per (source, title), then the first n per source."""
    order = [F.desc("similarity"), F.col("movie_id")]
    per_title = Window.partitionBy("source_id", "title_key").orderBy(*order)
    per_source = Window.partitionBy("source_id").orderBy(*order)
    return (
        ranked.withColumn("_copy", F.row_number().over(per_title))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
        .withColumn("rank", F.row_number().over(per_source))
        .filter(F.col("rank") <= n)
    )


def _without_shared_terms(catalogue: DataFrame, n: int) -> DataFrame:
    """Array of the rows that can fill a list with similarity 0, lowest ids first.

    Fewer than n titles are already listed and the source itself is left out,
    so the first 2n+1 titles with their two lowest ids always hold the answer.
    """
    per_title = Window.partitionBy("title_key").orderBy("movie_id")
    first_two = (
        catalogue.select("title_key", "movie_id")
        .withColumn("_copy", F.row_number().over(per_title))
        .filter(F.col("_copy") <= 2)
    )
    titles = first_two.groupBy("title_key").agg(F.sort_array(F.collect_list("movie_id")).alias("ids"))
    lowest = titles.orderBy(F.get("ids", F.lit(0))).limit(2 * n + 1)
    return lowest.agg(F.collect_list(F.struct("title_key", "ids")).alias("fill"))


def recommend(
    catalogue: DataFrame,
    weights: DataFrame,
    queries: DataFrame,
    n: int = 10,
    genre: str | None = None,
    min_year: int | None = None,
    max_year: int | None = None,
    min_rating: float | None = None,
) -> DataFrame:
    """The n most similar titles per source, equal ones by id, with an explanation.

    Filters act on the catalogue before the ranking; the weights always come from
    the whole catalogue. Rows without a shared term rank behind all others.
    """
    if n < 1:
        raise ValueError("number_of_recommendations must be at least 1.")
    kept = catalogue.filter(matches_filters(genre, min_year, max_year, min_rating)).withColumn(
        "title_key", text.normalize_title(F.col("title"))
    )
    keys = kept.select("movie_id", "title_key")
    near = _best_per_title(similarities(queries, weights).join(keys, "movie_id"), n)
    listed = near.groupBy("source_id").agg(F.collect_set("title_key").alias("_listed"))
    fill = _without_shared_terms(kept, n).scalar()
    short = (
        queries.select("source_id").distinct().join(listed, "source_id", "left")
        .withColumn("_listed", F.coalesce("_listed", F.array().cast("array<string>")))
        .filter(F.size("_listed") < n)
    )
    others = (
        short.withColumn("_fill", fill)
        .select("source_id", "_listed", F.inline("_fill"))
        .filter(~F.array_contains(F.col("_listed"), F.col("title_key")))
        .select("source_id", "title_key", F.explode("ids").alias("movie_id"), F.lit(0.0).alias("similarity"))
        .filter(F.col("movie_id") != F.col("source_id"))
    )
    columns = ["source_id", "movie_id", "title_key", "similarity"]
    ranked = _best_per_title(near.select(columns).unionByName(others.select(columns)), n)
    return _explained(ranked.select("source_id", "movie_id", "similarity", "rank"), catalogue)


def _explained(ranked: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add the details of each listed row and the terms it shares with the source.

    The list is stored before it is joined; its size decides whether the catalogue is shuffled.
    """
    words = F.array_distinct(text.tokens(F.col("tags")))
    source = catalogue.select(F.col("movie_id").alias("source_id"), words.alias("_source_words"))
    details = catalogue.select(
        "movie_id", "title", "genres", "release_year", "rating", words.alias("_words")
    )
    shared = shared_terms(F.col("_source_words"), F.col("_words"))
    sourced = written(written(ranked, "ranked").join(source, "source_id"), "sourced")
    year, rating = F.col("release_year").cast("int"), F.col("rating")
    return (
        sourced.join(details, "movie_id")
        .withColumn("shared", shared)
        .select(
            "source_id", "rank", "movie_id", "title", "genres", year.alias("release_year"), "rating", "similarity",
            F.when(F.size("shared") > 0, F.concat(F.lit(SHARED_TERMS), F.array_join("shared", ", ")))
            .otherwise(NO_SHARED_TERMS)
            .alias("explanation"),
            F.coalesce(year.cast("string"), F.lit(UNKNOWN)).alias("year_text"),
            F.coalesce(rating.cast("string"), F.lit(UNKNOWN)).alias("rating_text"),
        )
    )


def shared_terms(a: F.Column, b: F.Column, limit: int = 5) -> F.Column:
    """Common words without the ignored ones: longest first, then alphabetical."""
    common = F.array_except(F.array_intersect(a, b), text.literal_strings(IGNORED_WORDS))
    keyed = F.transform(common, lambda w: F.struct((-F.length(w)).alias("k"), w.alias("w")))
    return F.transform(F.slice(F.sort_array(keyed), 1, limit), lambda pair: pair["w"])
