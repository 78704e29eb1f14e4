"""Report containers: zip files that hold a UTF-16LE layout document."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.sources.files import file_name

_LAYOUT_MEMBER = "Report/Layout"


def read_report_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(report_name, layout_json, error) of every ``*.pbix`` file in ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pbix").load(path)
    return extract_layouts(
        files.select(F.regexp_replace(file_name(), r"\.pbix$", "").alias("report_name"), "content")
    )


def extract_layouts(containers: DataFrame) -> DataFrame:
    """(report_name, content) to (report_name, layout_json, error).

    Only unzipping and decoding run in Python, batch by batch inside the tasks; a file that is
    no zip, has no layout, is damaged or holds no UTF-16 becomes an error row and does not stop the others.
    """
    return containers.mapInPandas(_unzip, "report_name string, layout_json string, error string")


def _unzip(batches: Iterator) -> Iterator:
    import io
    import zipfile
    import zlib

    import pandas as pd

    def layout(content: bytes) -> tuple[str | None, str | None]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                # As when files are extracted one after the other, the last such member counts.
                names = [n for n in archive.namelist() if n.endswith(_LAYOUT_MEMBER)]
                return (archive.read(names[-1]).decode("utf-16-le"), None) if names else (None, f"no {_LAYOUT_MEMBER} in file")
        except zipfile.BadZipFile as problem:
            return None, f"no zip file: {problem}"
        except (zlib.error, EOFError, OSError, RuntimeError, NotImplementedError, UnicodeDecodeError) as problem:
            return None, f"damaged: {problem}"

    for batch in batches:
        found = [layout(bytes(content)) for content in batch["content"]]
        yield pd.DataFrame(
            {
                "report_name": batch["report_name"],
                "layout_json": pd.Series([f[0] for f in found], dtype=object, index=batch.index),
                "error": pd.Series([f[1] for f in found], dtype=object, index=batch.index),
            }
        )
