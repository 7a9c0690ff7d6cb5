"""External transforms: a callable on batches of rows, made once for each task and then fed with Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def transformed(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: T.StructType | str, catch: bool = True) -> DataFrame:
    """df through load()(batch), with status and error for each row.

    load is called once in each task, as a model is loaded once for many chunks. The callable returns the columns of schema
    other than status and error; it may add error itself, a text for each row it could not do, so that no batch has to be
    run twice. With catch, a batch that raises is halved until the rows that raise stand alone; they get status and error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def done(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
            try:
                out = model(batch)
            except Exception as e:  # noqa: BLE001  the message is the row's result
                if not catch:
                    raise
                if len(batch) == 1:
                    yield batch.assign(status="error", error=str(e))
                    return
                half = len(batch) // 2
                yield from done(batch.iloc[:half])
                yield from done(batch.iloc[half:])
                return
            error = out["error"].fillna("") if "error" in out else pd.Series("", index=out.index)
            yield out.assign(status=error.map(lambda e: "error" if e else "ok"), error=error)

        for batch in batches:
            if len(batch):
                yield from done(batch)

    return df.mapInPandas(run, schema)
