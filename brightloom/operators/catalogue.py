"""Catalogue tables: header mapping, cleaning, counting and title search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.functions import text
from brightloom.operators.ordering import row_numbers
from brightloom.operators.quality import lenient_number

# Letters of a piece of a title in the search postings.
GRAM = 3
# Canonical columns, text columns in tag order and header aliases.
CANONICAL = (
    "movie_id", "title", "genres", "overview", "keywords", "cast",
    "director", "production", "release_year", "rating",
)
TEXT_COLUMNS = ("genres", "overview", "keywords", "cast", "director", "production")
ALIASES = {
    "id": "movie_id",
    "movieid": "movie_id",
    "movie_title": "title",
    "name": "title",
    "genre": "genres",
    "description": "overview",
    "summary": "overview",
    "plot": "overview",
    "tagline": "overview",
    "actors": "cast",
    "stars": "cast",
    "producer": "production",
    "production_companies": "production",
    "year": "release_year",
    "release_date_year": "release_year",
    "vote_average": "rating",
    "score": "rating",
}
NO_TAGS = "unknown"


def standardize_columns(raw: DataFrame, order_by: str | None = None) -> DataFrame:
    """Map headers onto the canonical columns; other columns are kept as they are.

    Missing text columns become "", year and rating null, and ids 1..n in the
    order of `order_by` (a numeric column, as rows have no order of their own).
    Where several headers mean one column, the first non-null value counts.
    """
    found: dict[str, list[str]] = {}
    kept = []
    for header in raw.columns:
        key = text.header_key(header)
        target = key if key in CANONICAL else ALIASES.get(key)
        if target:
            found.setdefault(target, []).append(header)
        else:
            kept.append(header)
    if "title" not in found:
        raise ValueError("a title column such as 'title', 'movie_title' or 'name' is required")
    if "movie_id" not in found:
        if order_by is None:
            raise ValueError("ids are missing: name the numeric column that orders the rows")
        raw = row_numbers(raw, order_by, name="movie_id")
        found["movie_id"] = ["movie_id"]

    def column(target: str) -> Column:
        if target in found:
            return F.coalesce(*[F.col(f"`{h}`") for h in found[target]]).alias(target)
        default = F.lit("") if target in TEXT_COLUMNS else F.lit(None).cast("double")
        return default.alias(target)

    return raw.select(*[column(c) for c in CANONICAL], *[F.col(f"`{h}`") for h in kept])


def build_tags() -> Column:
    """Non-empty text columns joined by a blank, "unknown" if there are none."""
    pieces = F.filter(F.array(*[F.col(c) for c in TEXT_COLUMNS]), lambda piece: piece != "")
    joined = text.strip(F.array_join(pieces, " "))
    return F.when(joined == "", NO_TAGS).otherwise(joined)


def clean_catalogue(raw: DataFrame, order_by: str = "movie_id") -> DataFrame:
    """Titled rows, one per exact title (the first in `order_by`), with clean text and tags.

    The rank filter is applied per partition before the shuffle as well, so the
    copies of one frequent title never meet in one task.
    """
    table = standardize_columns(raw, order_by)
    texts = {c: text.blank_if_null(F.col(c).cast("string")) for c in TEXT_COLUMNS}
    titled = (
        table.withColumns({"title": text.strip(text.blank_if_null(F.col("title").cast("string"))), **texts})
        .filter(F.col("title") != "")
        .withColumns({c: lenient_number(F.col(c)) for c in ("release_year", "rating")})
    )
    first = F.row_number().over(Window.partitionBy("title").orderBy(order_by))
    unique = titled.withColumn("_copy", first).filter(F.col("_copy") == 1).drop("_copy")
    return unique.withColumns(
        {**{f"clean_{c}": text.clean_text(F.col(c)) for c in TEXT_COLUMNS}, "tags": build_tags()}
    )


def genre_counts(catalogue: DataFrame) -> DataFrame:
    """Rows per genre, after splitting lists of genres."""
    parts = F.explode(F.split(text.blank_if_null(F.col("genres")), r"[,|;/]+"))
    return (
        catalogue.select(parts.alias("genre"))
        .withColumn("genre", text.strip(F.col("genre")))
        .filter(F.col("genre") != "")
        .groupBy("genre")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_genres(catalogue: DataFrame, limit: int = 10) -> DataFrame:
    return genre_counts(catalogue).orderBy(F.desc("count"), "genre").limit(limit)


def year_counts(catalogue: DataFrame) -> DataFrame:
    """Rows per release year, ascending; unknown years are left out."""
    year = F.col("release_year").cast("int").alias("release_year")
    return (
        catalogue.filter(F.col("release_year").isNotNull())
        .groupBy(year)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("release_year")
    )


def search(catalogue: DataFrame, query: str, limit: int = 10, order_by: str = "movie_id") -> DataFrame:
    """First rows whose normalised title holds the normalised query; a blank query takes any row."""
    if not query.strip():
        return catalogue.orderBy(order_by).limit(limit)
    wanted = text.normalize_title(text.strip(F.lit(query)))
    held = F.contains(text.normalize_title(F.col("title")), wanted)
    return catalogue.filter(held).orderBy(order_by).limit(limit)


def title_postings(catalogue: DataFrame, order_by: str = "movie_id") -> DataFrame:
    """(gram, id, position): the letters that start at every position of a normalised title, up to three.

    The last two positions give shorter pieces, so titles of one or two letters
    are listed too. Rows are placed by range of (gram, id) and sorted: written as
    Parquet, a gram is read from the row groups whose bounds hold it, and a gram of
    very many titles spreads over several files. Ids have to be unique.
    """
    key = F.col("key")
    starts = F.when(F.length(key) > 0, F.sequence(F.lit(1), F.length(key)))
    return (
        catalogue.select(F.col(order_by).alias("id"), text.normalize_title(F.col("title")).alias("key"))
        .select("id", "key", F.explode(starts).alias("position"))
        .select(F.substring(key, F.col("position"), F.lit(GRAM)).alias("gram"), "id", "position")
        .repartitionByRange("gram", "id")
        .sortWithinPartitions("gram", "id", "position")
    )


def search_postings(
    postings: DataFrame, catalogue: DataFrame, query: str, limit: int | None = 10, order_by: str = "movie_id"
) -> DataFrame:
    """What `search` finds, read from postings; all of it where `limit` is None.

    Pieces of three letters that cover the query side by side (the last one may
    overlap) have to stand at their distances from one common start, which proves
    that the title holds the query. A query of one or two letters is looked up as
    the beginning of a piece. Titles are read only for the ids found.
    """
    wanted = catalogue.sparkSession.range(1).select(text.normalize_title(text.strip(F.lit(query)))).first()[0]
    if not query.strip() or not wanted:
        return catalogue.orderBy(order_by) if limit is None else search(catalogue, "", limit, order_by)
    if len(wanted) < GRAM:
        held = postings.filter(F.col("gram").startswith(wanted)).select("id").distinct()
    else:
        offsets = sorted({*range(0, len(wanted) - GRAM + 1, GRAM), len(wanted) - GRAM})
        pieces = {o: wanted[o:o + GRAM] for o in offsets}
        starts = F.filter(
            F.array(*[F.when(F.col("gram") == piece, F.col("position") - o) for o, piece in pieces.items()]),
            lambda start: start.isNotNull(),
        )
        held = (
            postings.filter(F.col("gram").isin(sorted(set(pieces.values()))))
            .select("id", F.explode(starts).alias("start"))
            .groupBy("id", "start").agg(F.count(F.lit(1)).alias("pieces"))
            .filter(F.col("pieces") == len(pieces)).select("id").distinct()
        )
    first = (held if limit is None else held.orderBy("id").limit(limit)).withColumnRenamed("id", order_by)
    return catalogue.join(first, order_by).select(*catalogue.columns).orderBy(order_by)


def close_titles(catalogue: DataFrame, query: str, limit: int = 5, order_by: str = "movie_id") -> DataFrame:
    """Titles that share words with the query: most shared words first, then by title."""
    wanted = F.array_distinct(text.tokens(text.normalize_title(F.lit(query))))
    shared = F.size(F.array_intersect(text.tokens(text.normalize_title(F.col("title"))), wanted))
    return (
        catalogue.select(order_by, "title", shared.cast("long").alias("overlap"))
        .filter(F.col("overlap") > 0)
        .orderBy(F.desc("overlap"), F.lower("title"), order_by)
        .limit(limit)
    )


def matches_filters(
    genre: str | None = None, min_year: int | None = None, max_year: int | None = None, min_rating: float | None = None
) -> Column:
    """Recommendation filters; a null year or rating fails an active bound."""
    year = F.col("release_year").cast("int")
    kept = F.lit(True)
    if genre:
        kept = kept & F.contains(F.lower(F.col("genres")), F.lit(genre.lower()))
    if min_year is not None:
        kept = kept & (year >= min_year)
    if max_year is not None:
        kept = kept & (year <= max_year)
    if min_rating is not None:
        kept = kept & (F.col("rating") >= float(min_rating))
    return kept
