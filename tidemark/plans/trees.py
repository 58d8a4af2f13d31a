"""Real file trees and document folders made from tables, for readers that need files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tree(rows: DataFrame, root: str) -> int:
    """Write each row's ``content`` to ``root``/``relative_path``; returns the number of files.

    A file appears under its name only when complete, so a repeated task does no harm.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        suffix = f".part-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for relative, content in zip(batch["relative_path"], batch["content"]):
                path = os.path.join(root, relative)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path + suffix, "wb") as handle:
                    handle.write(content)
                os.replace(path + suffix, path)
            yield pd.DataFrame({"written": [len(batch)]})

    counts = rows.select("relative_path", "content").mapInPandas(write, "written bigint")
    return counts.agg(F.sum("written")).first()[0] or 0
