"""A data source for tables of an SQLite file.

``spark.read.format("sqlite").option("path", ...).option("table", ...).load()``. The file has
to lie where every executor can read it. Row numbers are cut into ranges, one per task; the
row number comes along as ``reading_seq``, since file order is the only order such a table has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

BATCH_ROWS = 10_000


def _connect(path: str):
    import sqlite3

    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _spark_type(declared: str):
    declared = declared.upper()
    if "INT" in declared:
        return LongType()
    if any(word in declared for word in ("REAL", "FLOA", "DOUB", "NUM", "DEC")):
        return DoubleType()
    return StringType()


class RowRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path, self.table = options["path"], options["table"]
        self.tasks = int(options.get("numPartitions", "8"))
        self.schema = schema

    def partitions(self):
        with _connect(self.path) as con:
            first, last = con.execute(
                f"SELECT min(rowid), max(rowid) FROM {_quote(self.table)}").fetchone()
        if first is None:
            return [RowRange(0, -1)]
        step = max(1, -(-(last - first + 1) // self.tasks))
        return [RowRange(a, min(a + step - 1, last)) for a in range(first, last + 1, step)]

    def read(self, partition: RowRange):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        names = [f.name for f in self.schema]
        wanted = ", ".join("rowid" if n == "reading_seq" else _quote(n) for n in names)
        kinds = to_arrow_schema(self.schema)
        with _connect(self.path) as con:
            rows = con.execute(
                f"SELECT {wanted} FROM {_quote(self.table)} WHERE rowid BETWEEN ? AND ?",
                (partition.first, partition.last))
            while batch := rows.fetchmany(BATCH_ROWS):
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*batch), kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)


class SqliteSource(DataSource):
    """Options: path, table, numPartitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        with _connect(self.options["path"]) as con:
            found = con.execute(f"PRAGMA table_info({_quote(self.options['table'])})").fetchall()
        if not found:
            raise ValueError(f"no table {self.options['table']}")
        fields = [StructField(name, _spark_type(kind)) for _, name, kind, *_ in found]
        return StructType([StructField("reading_seq", LongType()), *fields])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, self.options)


def read_sqlite(spark: SparkSession, path: str, table: str, tasks: int = 8) -> DataFrame:
    """Scan a table; ``reading_seq`` is the row order of the file."""
    spark.dataSource.register(SqliteSource)
    return (spark.read.format("sqlite").option("path", path).option("table", table)
            .option("numPartitions", str(tasks)).load())
