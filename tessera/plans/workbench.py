"""SQL over registered tables, read-only, with helpers for what another dialect says differently."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class SqlWorkbench:
    """Tables by name; a query may only read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)

    def databases(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables())

    def table(self, name: str) -> DataFrame:
        return self.spark.table("`" + name.replace("`", "``") + "`")

    def query(self, text: str) -> DataFrame:
        if not re.match(r"(?is)\s*(?:--[^\n]*\n\s*)*(?:select|with|values|table|from|show|describe)\b", text):
            raise PermissionError("only queries that read")
        return self.spark.sql(text)

    def from_sqlite(self, text: str) -> DataFrame:
        """A query in the other dialect, where a plain rewriting of names is enough."""
        for pattern, new in ((r"(?i)\bgroup_concat\(", "listagg("), (r"(?i)\bifnull\(", "coalesce("), (r"(?i)\bjson_extract\(", "get_json_object("), (r"(?i)\bdate\('now'\)", "current_date()"), (r"(?i)\bprintf\(", "format_string(")):
            text = re.sub(pattern, new, text)
        return self.query(re.sub(r"(?i)(?<!i)\blike\b", "ILIKE", text))
