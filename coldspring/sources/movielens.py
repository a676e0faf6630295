"""Readers for the two public MovieLens layouts ('::' files and header CSV files)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspring.functions import text
from coldspring.sources.tables import Dataset, drop_orphans

# The files of each layout.
DAT_FILES = ("ratings.dat", "movies.dat", "users.dat")
CSV_FILES = ("ratings.csv", "movies.csv", "tags.csv")


def missing_files(spark: SparkSession, folder: str, names) -> list[str]:
    missing = []
    for name in names:
        try:
            spark.read.text(f"{folder}/{name}").schema
        except AnalysisException:
            missing.append(name)
    return missing


def _require(spark: SparkSession, folder: str, names) -> None:
    missing = missing_files(spark, folder, names)
    if missing:
        raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")


def read_dat(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """'::' separated, Latin-1, no header, quotes are ordinary characters. A row that does not fit the schema is an error."""
    return spark.read.csv(path, sep="::", encoding="ISO-8859-1", quote="", schema=schema, mode="FAILFAST")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header and quoted fields. A row that does not fit the schema is an error."""
    return spark.read.csv(path, header=True, quote='"', escape='"', schema=schema, mode="FAILFAST")


def catalog(movies: DataFrame) -> DataFrame:
    """(item_id, title, year, genres) from raw titles and genre strings."""
    return movies.select("item_id", text.clean_title(F.col("title")).alias("title"),
                         text.title_year(F.col("title")).alias("year"),
                         text.genre_list(F.col("genres")).alias("genres"))


def join_tags(tags: DataFrame) -> DataFrame:
    """(item_id, tags): the lower-case tags of an item as one string. A presentation column;
    the text features use the tag rows themselves, so no job depends on its size."""
    return (tags.groupBy("item_id")
            .agg(F.array_join(F.sort_array(F.collect_list(F.lower("tag"))), " ").alias("tags")))


def with_tags(items: DataFrame, tags: DataFrame | None) -> DataFrame:
    if tags is None:
        return items.withColumn("tags", F.lit(""))
    return items.join(join_tags(tags), "item_id", "left").withColumn("tags", F.coalesce("tags", F.lit("")))


def load_dat(spark: SparkSession, folder: str) -> Dataset:
    _require(spark, folder, DAT_FILES)
    ratings = read_dat(spark, f"{folder}/ratings.dat", "user_id long, item_id long, rating double, ts long")
    movies = read_dat(spark, f"{folder}/movies.dat", "item_id long, title string, genres string")
    users = read_dat(spark, f"{folder}/users.dat",
                     "user_id long, gender string, age int, occupation int, zip string").drop("zip")
    items = catalog(movies)
    return Dataset("ml-1m", drop_orphans(ratings, items), items, users, None)


def load_csv(spark: SparkSession, folder: str, name: str = "ml-latest-small") -> Dataset:
    _require(spark, folder, CSV_FILES)
    ratings = (read_csv(spark, f"{folder}/ratings.csv", "userId long, movieId long, rating double, timestamp long")
               .withColumnsRenamed({"userId": "user_id", "movieId": "item_id", "timestamp": "ts"}))
    movies = (read_csv(spark, f"{folder}/movies.csv", "movieId long, title string, genres string")
              .withColumnRenamed("movieId", "item_id"))
    tags = (read_csv(spark, f"{folder}/tags.csv", "userId long, movieId long, tag string, timestamp long")
            .select(F.col("movieId").alias("item_id"), F.lower("tag").alias("tag")))
    items = catalog(movies)
    return Dataset(name, drop_orphans(ratings, items), items, None, tags)
