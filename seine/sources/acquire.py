"""Responses for URLs by a function that the caller brings: the place where a network client is plugged in.

Nothing here opens a connection. URLs of one host are in one task and one after another, so a
client can keep its pace; hosts are dealt over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..session import ship_package

RESPONSES = "url string, status int, content_type string, body string, timed_out boolean, error string"


def acquire(pages: DataFrame, fetch: Callable[[str], tuple[int, str, str]], url_col: str = "url", most_bytes: int = 10 << 20) -> DataFrame:
    """A response for each distinct URL: what ``fetch`` gives (status, content type, body), or its error.

    A body over ``most_bytes`` is an error, as one that was cut would not parse. A null URL is left
    out. A task that is run again asks again, so write the result before it is used twice.
    """
    ship_package(pages.sparkSession)

    def one(url: str) -> tuple:
        try:
            status, kind, body = fetch(url)
        except TimeoutError as e:
            return url, None, None, None, True, str(e)
        except Exception as e:  # noqa: BLE001  whatever a client raises belongs to its URL
            return url, None, None, None, False, f"{type(e).__name__}: {e}"
        if len((body or "").encode()) > most_bytes:
            return url, status, kind, None, False, "too large"
        return url, status, kind, body, False, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([one(u) for u in batch["url"]], columns=["url", "status", "content_type", "body", "timed_out", "error"])
            yield out.astype({"status": "Int32"})

    rows = pages.select(F.col(url_col).alias("url")).where("url is not null").distinct()
    rows = rows.repartition(urls.hostname(F.col("url"))).sortWithinPartitions("url")
    return rows.mapInPandas(run, RESPONSES)
