"""Writing documents as files whose names come from the data."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from .files import MD_FOLDER


def file_system(base: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (a local path, ``hdfs://``, ``s3://``, ``gs://`` ...) and the path on it."""
    return fs.FileSystem.from_uri(base if "://" in base else os.path.abspath(base))


def write_markdown(documents: DataFrame, base: str, folder: str = MD_FOLDER) -> int:
    """Writes ``content`` of each row (``company, md_name, content``) to ``<base>/<company>/<folder>/<md_name>`` and returns how many.

    ``base`` is a folder that all executors share. A file is written beside its place and moved there, so a repeated task or a lost executor
    leaves either the old or the whole new file; rows must be unique by file (see ``latest_by_name``). Files are counted by what the finished
    tasks return, so repeated tasks count once.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(base)
        for b in batches:
            done = []
            for company, name, content in zip(b["company"], b["md_name"], b["content"], strict=True):
                place = f"{root}/{company}/{folder}"
                system.create_dir(place, recursive=True)
                part = f"{place}/.{name}.{os.getpid()}.part"
                with system.open_output_stream(part) as f:
                    f.write(content.encode("utf-8"))
                system.move(part, f"{place}/{name}")
                done.append(1)
            yield pd.DataFrame({"n": done}, dtype="int64")

    rows = documents.select("company", "md_name", "content").where("content is not null")
    return rows.mapInPandas(write, "n long").count()
