"""Fund reports from a table of stored documents.

Documents have (id, fundo, tipo_documento, data_referencia, content), where
``content`` is the report page as base64 text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions.joins import lookup_join
from saldo.operators.mappings import FUND_REPORT_TYPE, FUND_TABLE_HEADING

VALUE_CLASS = "dado-valores"

# The page walk travels with its task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_wanted(spark: SparkSession, path: str) -> DataFrame:
    """The wanted (fundo, data_referencia) of a JSON document, one object or a list of them."""
    found = spark.read.json(path, multiLine=True, schema="cnpj_fundo string, data_referencia string", mode="FAILFAST")
    return found.select(F.col("cnpj_fundo").alias("fundo"), "data_referencia").distinct()


def select_fund_documents(
    documents: DataFrame, wanted: DataFrame | None = None, required: bool = False
) -> DataFrame:
    """The latest structured report per fund and reference month.

    Highest id wins, found by an aggregate that combines within tasks, so a
    fund with very many documents is no hot group. ``wanted`` limits the
    result to (fundo, data_referencia) pairs; with ``required`` a pair without
    a report fails the job.
    """
    reports = documents.filter(F.trim("tipo_documento") == FUND_REPORT_TYPE)
    latest = reports.groupBy("fundo", "data_referencia").agg(F.max("id").alias("id"))
    if wanted is None:
        return latest
    pairs = wanted.select("fundo", "data_referencia").distinct()
    if not required:
        return lookup_join(latest, pairs, ["fundo", "data_referencia"], "left_semi")
    found = pairs.join(latest, ["fundo", "data_referencia"], "left")
    message = F.concat_ws(" ", F.lit("no report for"), "fundo", "data_referencia")
    return found.withColumn("id", F.when(F.col("id").isNull(), F.raise_error(message)).otherwise(F.col("id")))


def page_text(content: Column | str) -> Column:
    """Base64 page to text; bytes that are no UTF-8 become the replacement sign."""
    return F.make_valid_utf8(F.unbase64(content).cast("string"))


VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _TableRows(HTMLParser):
    """Walks a page and keeps the table around the first bold heading.

    Open elements form a stack. A row belongs to every open table, a cell to
    every open row and text to every open cell, so nested tables read the same
    as in a tree search.
    """

    def __init__(self, heading: str) -> None:
        super().__init__(convert_charrefs=True)
        self.heading = heading
        self.open: list[tuple[str, dict]] = []
        self.found = False
        self.chosen: dict | None = None

    def _within(self, tag: str) -> list[dict]:
        return [node for name, node in self.open if name == tag]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID_TAGS:
            return
        node: dict = {"children": [], "text": [], "value": None, "fills": []}
        if tag == "tr":
            for table in self._within("table"):
                table["children"].append(node)
        elif tag == "td":
            for row in self._within("tr"):
                row["children"].append(node)
        elif tag == "span" and VALUE_CLASS in (dict(attrs).get("class") or "").split():
            for cell in self._within("td"):
                if cell["value"] is None:
                    cell["value"] = []
                    node["fills"].append(cell["value"])
        self.open.append((tag, node))

    def handle_endtag(self, tag: str) -> None:
        if all(name != tag for name, _ in self.open):
            return
        name = ""
        while name != tag:
            name, node = self.open.pop()
            if name == "b" and not self.found and self.heading in "".join(node["text"]):
                self.found = True
                tables = self._within("table")
                self.chosen = tables[-1] if tables else None

    def handle_data(self, data: str) -> None:
        for name, node in self.open:
            if name == "b":
                node["text"].append(data)
            elif name == "td":
                node["text"].append(data.strip())
            for value in node["fills"]:
                value.append(data.strip())


def table_rows(page: str, heading: str = FUND_TABLE_HEADING) -> list[tuple[str, str]]:
    """Rows of the table that holds the heading, without its first row."""
    parser = _TableRows(heading)
    parser.feed(page)
    parser.close()
    if parser.chosen is None:
        raise ValueError(f"no table with the heading {heading!r}")
    rows = [
        ("".join(cells[0]["text"]), "".join(cells[1]["value"] or []).replace("R$", "").strip())
        for cells in (row["children"] for row in parser.chosen["children"][1:])
        if len(cells) >= 2
    ]
    if not rows:
        raise ValueError(f"the table with the heading {heading!r} has no rows")
    return rows


def fund_table_extract(
    documents: DataFrame, selected: DataFrame | None = None, heading: str = FUND_TABLE_HEADING
) -> DataFrame:
    """(fundo, data_referencia, id, linha, descricao, valor_str) of each report.

    Pages are decoded by Spark; only the walk through the markup is Python,
    one Arrow batch at a time. A page without the table fails the job.
    """
    chosen = select_fund_documents(documents) if selected is None else selected
    pages = lookup_join(documents, chosen.select("id"), "id", "left_semi").select(
        "fundo", "data_referencia", "id", page_text("content").alias("page")
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (d.fundo, d.data_referencia, d.id, n, text, value)
                for d in batch.itertuples(index=False)
                for n, (text, value) in enumerate(table_rows(d.page, heading), start=1)
            ]
            yield pd.DataFrame(
                found,
                columns=["fundo", "data_referencia", "id", "linha", "descricao", "valor_str"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = (
        f"fundo {kinds['fundo']}, data_referencia string, id {kinds['id']}, "
        "linha int, descricao string, valor_str string"
    )
    return pages.mapInPandas(parse, schema)
