"""Catalogue cleaning, counting, search and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.functions.words import ENGLISH_STOP_WORDS
from brightloom.operators import catalogue, quality, similarity
from brightloom.plans.sqltext import with_ctes
from brightloom.session import written
from brightloom.sources import views


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.clean_catalogue(views.raw_catalogue(spark, sf_dir))


def clean_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.standardize_columns(views.parts(spark, sf_dir)).withColumns(
        {c: quality.lenient_number(F.col(c)) for c in ("release_year", "rating")}
    )


def catalogue_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(spark, sf_dir).select(
        "movie_id", "title", "genres", "release_year", F.round("rating", 4).alias("rating"),
        F.md5("clean_overview").alias("overview_md5"), F.md5("tags").alias("tags_md5"),
    )


def catalogue_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = catalogue.clean_catalogue(views.parts(spark, sf_dir))
    return cleaned.select("movie_id", "title", "tags", "release_year", F.round("rating", 4).alias("rating"))


def genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.top_genres(clean_parts(spark, sf_dir), 10)


def year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.year_counts(clean_parts(spark, sf_dir)).select(F.col("release_year").cast("long"), "count")


def catalogue_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.ranges(clean_parts(spark, sf_dir), ["release_year", "rating"])
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 titles with the query, from stored postings of all titles."""
    parts = clean_parts(spark, sf_dir)
    postings = written(catalogue.title_postings(parts), "brightloom-titles")
    return catalogue.search_postings(postings, parts, " Red W", 20).select("movie_id", "title")


def title_search_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All titles with a query of one letter, from stored postings."""
    parts = clean_parts(spark, sf_dir)
    postings = written(catalogue.title_postings(parts), "brightloom-titles")
    return catalogue.search_postings(postings, parts, "Z", None).select("movie_id", "title")


def close_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.close_titles(clean_parts(spark, sf_dir), "Small blue ring!", 50)


def _docs(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.col("movie_id").alias("id"), "tags")


def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = similarity.tfidf(_docs(clean_documents(spark, sf_dir)))
    return weights.select("id", "term", F.round("weight", 6).alias("weight"))


def _liked(cleaned: DataFrame) -> DataFrame:
    """One liked title per director: the first in the catalogue."""
    return cleaned.groupBy("director").agg(F.min_by("title", "movie_id").alias("title")).select("title")


def _recommend(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    # Cleaning sorts and joins whole texts; it is done once and feeds the weights,
    # the queries and the details. Both tables are stored: cached blocks fill the memory
    # that the shuffles of all terms need, and are lost with their executor.
    cleaned = clean_documents(spark, sf_dir).drop(*[f"clean_{c}" for c in catalogue.TEXT_COLUMNS])
    cleaned = written(cleaned, "cleaned")
    weights = written(similarity.tfidf(_docs(cleaned)), "weights")
    queries = similarity.resolve_titles(cleaned, _liked(cleaned))
    return similarity.recommend(cleaned, weights, queries, **options)


def similar_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _recommend(spark, sf_dir, n=10)
    return found.select(
        "source_id", F.col("rank").cast("long"), "movie_id", "title", F.round("similarity", 6).alias("similarity")
    )


def similar_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered: English rows from 1960 on with a rating of 2 or more."""
    found = _recommend(spark, sf_dir, n=5, genre="EN|", min_year=1960, max_year=2015, min_rating=2.0)
    return found.select(
        "source_id", F.col("rank").cast("long"), "movie_id", "genres", F.round("similarity", 6).alias("similarity"),
        "explanation", "year_text",
    )


def unknown_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names that are no document title."""
    liked = views.table(spark, sf_dir, "part").select(F.col("p_name").alias("title")).distinct()
    return similarity.unknown_titles(clean_documents(spark, sf_dir), liked)


_CLEAN = r"""
raw AS (
  SELECT doc_id AS movie_id, regexp_replace(regexp_extract(text, '^[^.!?\n]*'), '^\s+|\s+$', '', 'g') AS title,
         lang || '|' || source AS genres, text AS overview, source AS director,
         CAST(1950 + doc_id % 70 AS DOUBLE) AS release_year, (doc_id % 101) / 10 AS rating
  FROM documents),
cat AS (
  SELECT *, regexp_replace(genres || ' ' || overview || ' ' || director, '^\s+|\s+$', '', 'g') AS tags,
         regexp_replace(regexp_replace(lower(title), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g') AS title_key
  FROM raw WHERE title <> '' QUALIFY row_number() OVER (PARTITION BY title ORDER BY movie_id) = 1)"""

_PARTS = """
parts AS (SELECT p_partkey AS movie_id, p_name AS title, p_type || '|' || p_brand AS genres, p_brand AS production,
                 CAST(p_size AS DOUBLE) AS release_year, p_retailprice / 100 AS rating FROM part)"""


def _tfidf_ctes() -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
    return _CLEAN + rf""",
words AS (
  SELECT movie_id AS id, list_filter(regexp_extract_all(lower(tags), '[\p{{L}}\p{{M}}\p{{N}}_]{{2,}}'),
         lambda w: w NOT IN ({listed})) AS ws FROM cat),
terms AS (
  SELECT id, unnest(ws) AS term FROM words
  UNION ALL
  SELECT id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM words WHERE len(ws) > 1),
tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term),
vocab AS (
  SELECT term, ln((1 + (SELECT count(*) FROM cat)) / (1 + count(*))) + 1 AS idf
  FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 10000),
w AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM w)"""


def _similar_ctes(kept: str) -> str:
    return _tfidf_ctes() + f""",
liked AS (SELECT arg_min(title_key, movie_id) AS title_key FROM cat GROUP BY director),
queries AS (SELECT DISTINCT max(movie_id) AS source_id FROM cat SEMI JOIN liked USING (title_key) GROUP BY title_key),
dots AS (
  SELECT q.id AS source_id, d.id AS movie_id, sum(q.weight * d.weight) AS similarity
  FROM weights q JOIN weights d USING (term) WHERE q.id IN (SELECT source_id FROM queries) GROUP BY 1, 2),
pairs AS (
  SELECT source_id, c.movie_id, c.title_key, coalesce(similarity, 0) AS similarity
  FROM queries CROSS JOIN cat c LEFT JOIN dots USING (source_id, movie_id)
  WHERE c.movie_id <> source_id AND {kept}
  QUALIFY row_number() OVER (PARTITION BY source_id, c.title_key ORDER BY round(coalesce(similarity, 0), 12) DESC, c.movie_id) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY round(similarity, 12) DESC, movie_id) AS rank FROM pairs)"""


_IGNORED = ", ".join(f"'{w}'" for w in similarity.IGNORED_WORDS)
_KEPT = (
    "contains(lower(c.genres), 'en|') AND c.release_year >= 1960 AND c.release_year <= 2015 AND c.rating >= 2.0"
)

PLANS = {
    "catalogue_clean": (
        catalogue_clean,
        with_ctes(
            _CLEAN,
            r"""SELECT movie_id, title, genres, release_year, round(rating, 4) AS rating,
              md5(trim(regexp_replace(regexp_replace(lower(overview), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS overview_md5,
              md5(tags) AS tags_md5 FROM cat""",
        ),
    ),
    "catalogue_dedupe": (
        catalogue_dedupe,
        with_ctes(
            _PARTS,
            """SELECT movie_id, title, genres || ' ' || production AS tags, release_year, round(rating, 4) AS rating
            FROM parts QUALIFY row_number() OVER (PARTITION BY title ORDER BY movie_id) = 1""",
        ),
    ),
    "genre_counts": (
        genre_counts,
        with_ctes(
            _PARTS,
            r"""SELECT trim(g) AS genre, count(*) AS count
            FROM (SELECT unnest(string_split_regex(genres, '[,|;/]+')) AS g FROM parts) WHERE trim(g) <> ''
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        ),
    ),
    "year_counts": (
        year_counts, "SELECT CAST(p_size AS BIGINT) AS release_year, count(*) AS count FROM part GROUP BY 1"
    ),
    "catalogue_ranges": (
        catalogue_ranges,
        with_ctes(
            _PARTS,
            """SELECT min(release_year) AS min_release_year, max(release_year) AS max_release_year,
                      round(min(rating), 4) AS min_rating, round(max(rating), 4) AS max_rating FROM parts""",
        ),
    ),
    "title_search": (
        title_search,
        "SELECT p_partkey AS movie_id, p_name AS title FROM part WHERE contains(lower(p_name), 'red w') ORDER BY 1 LIMIT 20",
    ),
    "title_search_short": (
        title_search_short, "SELECT p_partkey AS movie_id, p_name AS title FROM part WHERE contains(lower(p_name), 'z')"
    ),
    "close_titles": (
        close_titles,
        """
        WITH t AS (SELECT p_partkey AS movie_id, p_name AS title,
          len(list_intersect(list_distinct(string_split(p_name, ' ')), ['small', 'blue', 'ring'])) AS overlap FROM part)
        SELECT movie_id, title, overlap FROM t WHERE overlap > 0 ORDER BY overlap DESC, lower(title), movie_id LIMIT 50""",
    ),
    "tfidf_terms": (
        tfidf_terms,
        with_ctes(_tfidf_ctes(), "SELECT id, term, round(weight, 6) AS weight FROM weights"),
    ),
    "similar_items": (
        similar_items,
        with_ctes(
            _similar_ctes("true"),
            """SELECT source_id, rank, movie_id, title, round(similarity, 6) AS similarity
            FROM ranked JOIN cat USING (movie_id) WHERE rank <= 10""",
        ),
    ),
    "similar_explained": (
        similar_explained,
        with_ctes(
            _similar_ctes(_KEPT)
            + rf""",
        best AS (
          SELECT source_id, rank, c.movie_id, c.genres, similarity, c.release_year,
            list_filter(list_intersect(list_distinct(string_split_regex(c.tags, '\s+')), list_distinct(string_split_regex(s.tags, '\s+'))),
                        lambda x: x <> '' AND x NOT IN ({_IGNORED})) AS common
          FROM ranked r JOIN cat c ON c.movie_id = r.movie_id JOIN cat s ON s.movie_id = r.source_id WHERE rank <= 5),
        named AS (
          SELECT * EXCLUDE (common), list_transform(
            list_sort(list_transform(common, lambda x: {{'k': -length(x), 'w': x}}))[1:5], lambda p: p.w) AS shared FROM best)""",
            """SELECT source_id, rank, movie_id, genres, round(similarity, 6) AS similarity,
              CASE WHEN len(shared) > 0 THEN 'Shares metadata terms: ' || array_to_string(shared, ', ')
                   ELSE 'Ranked by similarity across the available movie metadata.' END AS explanation,
              CAST(CAST(release_year AS INT) AS VARCHAR) AS year_text
            FROM named""",
        ),
    ),
    "unknown_titles": (
        unknown_titles,
        with_ctes(
            _CLEAN,
            "SELECT DISTINCT p_name AS title FROM part WHERE p_name NOT IN (SELECT title_key FROM cat)",
        ),
    ),
}
