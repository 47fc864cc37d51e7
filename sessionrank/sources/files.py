"""Reading the raw files and results, writing stage tables and results."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sessionrank import schemas


def _read_separated(spark, path, separator, schema, **options):
    return spark.read.csv(path, sep=separator, schema=schema, header=False, quote="", **options)


def read_ratings(spark, folder, separator="::", folders=False):
    """ratings.dat: user, item, rating, epoch seconds. With `folders` it holds folders of files, all of which are read."""
    options = {"recursiveFileLookup": True} if folders else {}
    return _read_separated(spark, f"{folder}/ratings.dat", separator, schemas.RATINGS, **options)


def read_movies(spark, folder, separator="::"):
    """movies.dat (latin-1): item, title, genres, and the genres as a list."""
    movies = _read_separated(
        spark, f"{folder}/movies.dat", separator, schemas.MOVIES, encoding="ISO-8859-1"
    )
    return movies.withColumn("genre_list", F.split("genres", r"\|"))


def read_users(spark, folder, separator="::"):
    """users.dat: user, gender, age, occupation, zip code."""
    return _read_separated(spark, f"{folder}/users.dat", separator, schemas.USERS)


# Columns that order rows as they stand in their files.
INPUT_ORDER = ("input_file", "input_block", "input_row")


def with_input_order(df):
    """Rows read from files, as they come from the reader, with INPUT_ORDER: file, split and place in it.

    Sorting by these columns gives the files in the order of their paths and the lines or rows of a file in theirs, whatever the
    number of tasks: a split is read by one task from front to back, so numbers that grow within a task keep its order.
    """
    return df.select(
        *df.columns, F.col("_metadata.file_path").alias("input_file"), F.col("_metadata.file_block_start").alias("input_block"),
        F.monotonically_increasing_id().alias("input_row"),
    )


def write_table(df, path, partition_by=()):
    """Writes a stage table, replacing it."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_table(spark, path):
    """Reads a stage table."""
    return spark.read.parquet(path)


def safe_name(system):
    """A system's name as used in file names."""
    return system.replace("+", "_")


def write_results(results, path, by_system=False):
    """Writes results as CSV with header; `by_system` makes one folder per system."""
    if by_system:
        results = results.withColumn("system", F.translate("system", "+", "_"))
        results.write.mode("overwrite").partitionBy("system").csv(path, header=True)
    else:
        results.write.mode("overwrite").csv(path, header=True)


def read_results(spark, path, schema):
    """Reads results written by `write_results`; None if there are none."""
    try:
        return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
