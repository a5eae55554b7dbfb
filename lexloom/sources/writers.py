"""Sinks. Directories are written by Spark; ``single`` gathers parts into one file for tools that want one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').csv(path)


def write_chunks(df: DataFrame, path: str, chunk: str) -> None:
    """One directory a chunk."""
    df.write.mode("overwrite").partitionBy(chunk).option("header", True).option("escape", '"').csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text a line, as it is; for JSON lines."""
    df.select(column).write.mode("overwrite").text(path)


def _open(path: str):
    """A new file in whatever file system the path names."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name)


def single(df: DataFrame, path: str, bom: bool = False) -> None:
    """A small result as one CSV file, with a byte order mark if asked; rows are streamed, not gathered. ``path`` may be a URI."""
    import csv
    import io

    with _open(path) as f:
        f.write("\ufeff".encode() if bom else b"")
        text = io.StringIO(newline="")
        out = csv.writer(text)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            if text.tell() > 1 << 16:
                f.write(text.getvalue().encode())
                text.seek(text.truncate(0))
        f.write(text.getvalue().encode())


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and the others with it as ``reject_reason``."""
    judged = df.withColumn("reject_reason", reason)
    return judged.filter("reject_reason IS NULL").drop("reject_reason"), judged.filter("reject_reason IS NOT NULL")


def bulk_lines(df: DataFrame, index: str, doc_id: Column) -> DataFrame:
    """(line): a search index's bulk format, action and source of each row on two lines."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), doc_id.alias("_id")).alias("index")))
    return df.select(F.concat_ws("\n", action, F.to_json(F.struct("*"))).alias("line"))


def index_requests(df: DataFrame, index: str, doc_id: Column, recreate: bool, mapping: str = "{}") -> DataFrame:
    """(step, method, path, body): what to send to a search index, in order of step.

    With ``recreate`` the index is dropped first, else it is made only if missing; the
    documents follow as bulk lines.
    """
    spark = df.sparkSession
    first = [(1, "DELETE", f"/{index}?ignore_unavailable=true", "")] if recreate else [(1, "HEAD", f"/{index}", "")]
    head = spark.createDataFrame([*first, (2, "PUT", f"/{index}", mapping)], "step int, method string, path string, body string")
    return head.unionByName(bulk_lines(df, index, doc_id).select(F.lit(3).alias("step"), F.lit("POST").alias("method"), F.lit("/_bulk").alias("path"), F.col("line").alias("body")))


def write_files(df: DataFrame, name: str, body: str, directory: str) -> None:
    """One text file a row, in the shared folder ``directory``; names may hold folders. A task that runs again writes the same files."""

    def put(rows):
        for r in rows:
            with _open(f"{directory.rstrip('/')}/{r[name]}") as f:
                f.write((r[body] or "").encode())

    df.select(name, body).foreachPartition(put)
