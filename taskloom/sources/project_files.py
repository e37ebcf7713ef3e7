"""Project files as a data source: spark.read.format("projects").load(folder).

One row for each .sm or .mm file below the folder, bad ones with `error`. Many small files share a partition. Filters on
kind (sm or mm) and file (the name) are taken over by the source, so files they rule out are not opened
(spark.sql.python.filterPushdown.enabled has to be on for that). Options: path, kind, partitionBytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .files import located, read_file
from .projects import PARSED, BadFile, parse_project

SCHEMA = "file string, kind string, " + PARSED


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _plain(value):
    """Maps as lists of pairs, as Arrow takes them; structs stay."""
    if isinstance(value, dict):
        return {k: list(v.items()) if k in ("demands", "renewable_demands", "nonrenewable_demands") and v is not None else _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


class ProjectReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.folder = schema, options["path"]
        self.limit = int(options.get("partitionbytes", options.get("partitionBytes", 4 << 20)))
        self.wanted = {"kind": {options["kind"]}} if options.get("kind") else {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) else None
            if column in ("kind", "file"):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted[column] = self.wanted[column] & values if column in self.wanted else values
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        store, root = located(self.folder)
        found, held, total = [], [], 0
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            kind = info.path.rsplit(".", 1)[-1]
            if info.type != fs.FileType.File or kind not in ("sm", "mm") or kind not in self.wanted.get("kind", {kind}) or info.base_name not in self.wanted.get("file", {info.base_name}):
                continue
            held.append(info.path)
            total += max(info.size or 0, 1 << 12)
            if total >= self.limit:
                found.append(Files(held))
                held, total = [], 0
        return [*found, Files(held)] if held else found or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = located(self.folder)
        schema, names = to_arrow_schema(self.schema), self.schema.fieldNames()
        for k in range(0, len(partition.paths), 64):
            rows = []
            for path in partition.paths[k : k + 64]:
                file = path.rsplit("/", 1)[-1]
                name, kind = file.rsplit(".", 1)
                row = dict.fromkeys(names) | {"instance_id": name, "source": name}
                try:
                    row |= _plain(parse_project((read_file(store, path) or b"").decode(), name, kind))
                except (BadFile, ValueError, IndexError, TypeError) as e:
                    row["error"] = str(e) or type(e).__name__
                rows.append(row | {"file": file, "kind": kind})
            yield pa.RecordBatch.from_pylist(rows, schema)


class ProjectFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "projects"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ProjectReader:
        return ProjectReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ProjectFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
