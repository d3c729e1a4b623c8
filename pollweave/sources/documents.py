"""Pages, stop words and nested JSON as DataFrames."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Answers of a server after which a request is tried again.
RETRIED = (429, 500, 502, 503, 504)


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(url_md5, text)`` of a folder of text files named by the md5 of their address, or in folders so named; the line
    feed at a file's end is not part of the text."""
    d = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("f"), "value")
    return d.select(F.regexp_extract("f", r"([0-9a-f]{32})(?:\.\w+|/[^/]*)$", 1).alias("url_md5"), F.regexp_replace("value", r"\n\z", "").alias("text"))


def cached_pages(urls: DataFrame, url: str, cache: DataFrame) -> DataFrame:
    """``urls`` with ``text`` from the cache by md5 of the address; an address that is not cached has ''."""
    c = cache.select(F.col("url_md5").alias("__k"), F.col("text").alias("__t"))
    got = urls.join(c, F.md5(F.col(f"`{url}`")) == F.col("__k"), "left")
    return got.withColumn("text", F.coalesce("__t", F.lit(""))).drop("__k", "__t")


class Fetcher:
    """Reads an address with a time limit, trying again after a growing pause; another ``read`` can be given."""

    def __init__(self, timeout: float = 10.0, retries: int = 3, pause: float = 1.0, read: Callable[[str, float], str] | None = None):
        self.timeout, self.retries, self.pause, self.read = timeout, retries, pause, read or self._read

    @staticmethod
    def _read(url: str, timeout: float) -> str:
        request = urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")

    def __call__(self, url: str) -> tuple[str, str | None]:
        """``(text, None)``, or ``('', what went wrong)``; an address that fails never stops the others."""
        for attempt in range(self.retries + 1):
            try:
                return self.read(url, self.timeout), None
            except Exception as e:  # noqa: BLE001 - isolated per address
                what = f"{type(e).__name__}: {e}"
                if getattr(e, "code", RETRIED[0]) not in RETRIED:
                    break
                if attempt < self.retries:
                    time.sleep(self.pause * 2**attempt)
        return "", what


def fetched(urls: DataFrame, url: str, fetcher: Fetcher, to_text: Callable[[str | None], str | None] | None = None) -> DataFrame:
    """``(url, text, error)`` of each distinct non-null address; a page that fails has '' and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fetcher(u) for u in b.column("url").to_pylist()]
            texts = [to_text(t) if to_text and not e else t for t, e in got]
            yield pa.RecordBatch.from_arrays([b.column("url"), pa.array(texts, pa.string()), pa.array([e for _, e in got], pa.string())], names=["url", "text", "error"])

    return urls.select(F.col(f"`{url}`").alias("url")).where("url is not null").distinct().mapInArrow(run, "url string, text string, error string")


def cached_or_fetched(urls: DataFrame, url: str, cache: DataFrame, fetcher: Fetcher, to_text: Callable[[str | None], str | None] | None = None) -> DataFrame:
    """``(url, text, error, cached)`` of each distinct address: from the cache where its md5 is there, else fetched."""
    want = urls.select(F.col(f"`{url}`").alias("url")).where("url is not null").distinct().withColumn("url_md5", F.md5("url"))
    here = want.join(cache.select("url_md5", "text"), "url_md5").select("url", "text", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
    missing = want.join(cache.select("url_md5"), "url_md5", "left_anti")
    return here.unionByName(fetched(missing, "url", fetcher, to_text).withColumn("cached", F.lit(False)))


def save_pages(pages: DataFrame, folder: str) -> None:
    """Adds pages that were fetched without error to a cache folder that :func:`page_files` reads."""
    new = pages.where("error is null and not cached").select(F.md5("url").alias("url_md5"), F.col("text").alias("value"))
    new.write.mode("append").partitionBy("url_md5").text(folder)


def stop_words(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``word`` of a file with one word per line, and literals; each once."""
    f = spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''")
    return f.union(spark.createDataFrame([(w,) for w in extra], "word string")).distinct() if extra else f.distinct()


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Nested documents by an explicit schema, so dynamic keys become map entries."""
    return spark.read.schema(schema).json(path, multiLine=True)
