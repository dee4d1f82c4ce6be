"""Landing files: which are expected, whether they arrived, reading them as text and
keeping them as bronze tables."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mercato.operators.checks import CheckFailed
from mercato.session import materialize
from mercato.sources.catalog import append_log, measures_of, publish_table


@dataclass(frozen=True)
class LandingFile:
    system: str
    name: str
    table: str
    # Source header -> column name of the typed layer.
    columns: dict[str, str]

    @property
    def file(self) -> str:
        return f"{self.name}.csv"

    def path(self, base: str) -> str:
        return os.path.join(base, self.system, self.file)


# File names and headers of the original extracts.
ORIGINAL = (
    LandingFile("erp", "produtos", "product", {
        "sku": "sku", "descricao": "title", "categoria": "category", "marca": "brand",
        "nota_olfativa": "note", "preco_tabela": "list_price", "custo_unitario": "unit_cost",
        "unidade": "unit", "ativo": "active", "data_lancamento": "launched_on",
    }),
    LandingFile("erp", "pedidos", "order", {
        "pedido_id": "order_id", "cliente_id": "client_id", "vendedor_id": "rep_id",
        "data_pedido": "ordered_on", "canal": "channel", "status": "status",
        "valor_total": "total_value",
    }),
    LandingFile("erp", "itens_pedido", "line", {
        "item_id": "line_id", "pedido_id": "order_id", "sku": "sku", "quantidade": "quantity",
        "preco_praticado": "unit_price", "desconto_pct": "discount_pct", "valor_bruto": "gross_value",
    }),
    LandingFile("erp", "pagamentos", "payment", {
        "pagamento_id": "payment_id", "pedido_id": "order_id", "forma_pagamento": "method",
        "parcelas": "installments", "valor": "amount", "taxa_pct": "fee_pct",
        "valor_liquido": "net_amount", "data_vencimento": "due_on", "data_pagamento": "paid_on",
        "status_pagamento": "payment_status",
    }),
    LandingFile("erp", "estoque", "stock", {
        "data_snapshot": "snapshot_on", "sku": "sku", "saldo": "balance",
    }),
    LandingFile("crm", "clientes", "client", {
        "cliente_id": "client_id", "cnpj": "tax_id", "razao_social": "legal_name",
        "segmento": "segment", "cidade": "city", "uf": "state", "bairro": "district",
        "data_cadastro": "registered_on", "ativo": "active",
    }),
    LandingFile("crm", "vendedores", "rep", {
        "vendedor_id": "rep_id", "nome": "rep_name", "regiao": "region", "uf": "state",
        "data_admissao": "hired_on", "data_desligamento": "terminated_on", "meta_mensal": "monthly_target",
    }),
    LandingFile("crm", "carteira", "portfolio", {
        "carteira_id": "portfolio_id", "cliente_id": "client_id", "vendedor_id": "rep_id",
        "data_inicio": "started_on", "data_fim": "ended_on",
    }),
    LandingFile("crm", "oportunidades", "opportunity", {
        "oportunidade_id": "opportunity_id", "cliente_id": "client_id", "vendedor_id": "rep_id",
        "origem": "origin", "data_abertura": "opened_on", "etapa": "stage",
        "probabilidade_pct": "probability_pct", "valor_estimado": "estimated_value",
        "data_fechamento": "closed_on", "ciclo_dias": "cycle_days", "motivo_perda": "loss_reason",
    }),
    LandingFile("crm", "visitas", "visit", {
        "visita_id": "visit_id", "cliente_id": "client_id", "vendedor_id": "rep_id",
        "data_visita": "visited_on", "resultado": "result", "duracao_min": "duration_min",
    }),
)
# The same files with the engine's own names, as the test data is landed.
PLAIN = tuple(
    LandingFile(f.system, f.table, f.table, {name: name for name in f.columns.values()}) for f in ORIGINAL
)


def scan_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or a folder of its parts, with header; every column text.

    All parts must have one header, in one order, and each row as many fields: another
    header, a missing or an extra field fails the read and names the file, so that
    no value lands in another column."""
    reader = spark.read.option("header", True)
    header = reader.option("inferSchema", False).csv(path).columns
    text = StructType([StructField(c, StringType()) for c in header])
    strict = reader.schema(text).option("enforceSchema", False).option("mode", "FAILFAST")
    return strict.option("columnPruning", False).csv(path)


def lineage_columns(df: DataFrame) -> DataFrame:
    """Ingest time and the landing file each row came from, also where that is a folder
    of parts."""
    place = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+\.csv)(?:/[^/]+)?$", 1)
    return df.select("*", F.current_timestamp().alias("ingested_at"), place.alias("source_file"))


# -- arrival ---------------------------------------------------------------------

def arrivals(spark: SparkSession, base: str, expected: tuple[LandingFile, ...]) -> DataFrame:
    """Expected files with bytes and data rows; NULL bytes for a missing one. One
    listing and one counting pass over all files together."""
    manifest = spark.createDataFrame([(f.system, f.file) for f in expected], "system string, file string")
    try:
        sizes = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").load(base).select("path", "length")
        )
        counts = (
            spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .option("header", True).schema("first_column string").csv(base)
            .groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return manifest.select("system", "file", F.lit(None).cast("bigint").alias("bytes"), F.lit(0).cast("bigint").alias("rows"))
    # A file, or a folder of that name holding its parts.
    place = r"/([^/]+)/([^/]+\.csv)(?:/[^/]+)?$"

    def placed(df: DataFrame) -> DataFrame:
        path = F.col("path")
        return df.select(
            F.regexp_extract(path, place, 1).alias("system"), F.regexp_extract(path, place, 2).alias("file"), "*"
        )

    size = placed(sizes).groupBy("system", "file").agg(F.sum("length").alias("bytes"))
    rows = placed(counts).groupBy("system", "file").agg(F.sum("n").alias("rows"))
    return (
        manifest.join(size, ["system", "file"], "left")
        .join(rows, ["system", "file"], "left")
        .select("system", "file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"))
    )


def fingerprint(spark: SparkSession, base: str) -> tuple[int, int, int]:
    """Number, bytes and a hash of path, size and time of all landing files, from their
    listing; it changes when a file does."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(base)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, 0, 0
    each = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.bit_xor(each), F.lit(0))).first()
    return tuple(row)


def arrival_check(spark: SparkSession, base: str, expected: tuple[LandingFile, ...]) -> DataFrame:
    """One row per expected file, or CheckFailed listing all missing and all empty
    ones. As many rows as there are files, so they pass through the driver."""
    found = arrivals(spark, base, expected).collect()
    missing = sorted(f"{r['system']}/{r['file']}" for r in found if r["bytes"] is None)
    empty = sorted(f"{r['system']}/{r['file']}" for r in found if r["bytes"] is not None and not r["rows"])
    problems = [f"{what}: {', '.join(names)}" for what, names in (("missing", missing), ("empty", empty)) if names]
    if problems:
        raise CheckFailed("arrival check failed, " + "; ".join(problems))
    out = spark.createDataFrame([tuple(r) for r in found], "system string, file string, bytes bigint, rows bigint")
    return out.withColumn("checked_at", F.current_timestamp())


def arrival_log(checked: DataFrame, table: str) -> DataFrame:
    return append_log(checked, table, "One row per landing file and run: size, rows, time of the check.")


# -- rejected rows --------------------------------------------------------------------

REJECTED = "rejected"
HEADER, SHORT, LONG, UNREADABLE = "other header", "missing fields", "extra fields", "unreadable"


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All lines of a file, or of a folder of parts, as `value`, `file`, `line` (from 1) and
    `header` (the first line of that file); and one row for each block of a file with its
    first line and number of lines. Lines are numbered within a block as they are read, and
    the blocks before it are added; blocks are as many as tasks, whatever the rows."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    blocks = materialize(
        lines.groupBy("file", "block").agg(
            F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.min_by("value", "at").alias("first"),
            F.count_if(F.trim("value") == "").alias("blank"),
        ),
        "blocks",
    )
    order = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    header = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    known = blocks.select("file", "block", "first_at", before.alias("before"), header.alias("header"))
    placed = lines.join(known, ["file", "block"])
    return placed.select("value", "file", (F.col("before") + F.col("at") - F.col("first_at") + 1).alias("line"), "header"), blocks


def sorted_out(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of a landing file that fit its header `columns`, those that do not, and the
    blocks of `numbered_lines`.

    A part whose first line is not that header is rejected with all its rows, as its
    values cannot be told apart; in other parts a row with a missing or an extra field,
    or with quotes that do not close, is. Rejected rows have `file`, `line`, `reason` and
    `value`, the line as it stands. Blank lines are no rows. No value moves to another
    column, and every line but headers and blanks is in one of the two."""
    placed, blocks = numbered_lines(spark, path)
    rows = placed.where((F.col("line") > 1) & (F.trim("value") != ""))
    fits = F.trim(F.replace(F.col("header"), F.lit('"'), F.lit(""))) == F.lit(",".join(columns))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = lambda names: ", ".join(f"`{c}` string" for c in [*names, "_corrupt"])
    parsed = rows.withColumn("parsed", F.from_csv("value", text(columns), options))
    whole = fits & F.col("parsed._corrupt").isNull()
    good = parsed.where(whole).select(*[F.col("parsed")[c].alias(c) for c in columns], "file")
    # With one field more than there should be, an extra field fits.
    wider = F.from_csv("value", text(f"c{k}" for k in range(len(columns) + 1)), options)
    extra = wider["_corrupt"].isNull() | wider[f"c{len(columns)}"].isNotNull()
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    reason = F.when(~fits, HEADER).when(quotes % 2 == 1, UNREADABLE).when(extra, LONG).otherwise(SHORT)
    bad = parsed.where(~whole).select("file", "line", reason.alias("reason"), "value")
    return good, bad, blocks


def bronze_quarantine(
    spark: SparkSession, base: str, file: LandingFile, database: str, max_share: float = 0.01
) -> DataFrame:
    """A landing file as a bronze table, rows that do not fit it as `<table>_rejected` with
    file, line and reason. If more than `max_share` of the rows are rejected, CheckFailed:
    the rejected rows can be looked at, and the bronze table stays as it was. Both are
    counted while they are written; together they are all rows that arrived."""
    good, bad, blocks = sorted_out(spark, file.path(base), list(file.columns))
    name, counted = f"{database}.{file.table}", {"rows": F.count(F.lit(1))}
    place = F.regexp_extract(F.col("file"), r"/([^/]+\.csv)(?:/.*)?$", 1)
    stamped = [F.current_timestamp().alias("ingested_at"), place.alias("source_file")]
    publish_table(
        bad.select(*stamped, "*"), f"{name}_{REJECTED}", f"Rows of {file.system}/{file.file} that do not fit it.", measures=counted
    )
    rejected = int(measures_of(spark, f"{name}_{REJECTED}")["rows"])
    lines = blocks.agg(F.sum("n"), F.sum("blank"), F.countDistinct("file")).first()
    arrived = (lines[0] or 0) - (lines[1] or 0) - lines[2]
    if rejected > max_share * arrived:
        raise CheckFailed(f"{file.system}/{file.file}: {rejected} of {arrived} rows do not fit, more than {max_share:.2%}")
    out = publish_table(
        good.select(*file.columns, *stamped), name, f"Copy of {file.system}/{file.file}, all text, nothing cleaned.", measures=counted
    )
    kept = int(measures_of(spark, name)["rows"])
    if kept + rejected != arrived:
        raise CheckFailed(f"{file.system}/{file.file}: {kept} rows and {rejected} rejected are not the {arrived} that arrived")
    return out


# -- bronze ------------------------------------------------------------------------

def bronze_ingest(spark: SparkSession, base: str, file: LandingFile, database: str) -> DataFrame:
    raw = lineage_columns(scan_csv_text(spark, file.path(base)))
    return publish_table(
        raw, f"{database}.{file.table}", f"Copy of {file.system}/{file.file}, all text, nothing cleaned."
    )


def _kept_and_rejected(spark: SparkSession, name: str) -> DataFrame:
    kept = spark.table(name).select(F.lit(1).alias("one"))
    if spark.catalog.tableExists(f"{name}_{REJECTED}"):
        kept = kept.unionAll(spark.table(f"{name}_{REJECTED}").select(F.lit(1)))
    return kept


def row_count_reconcile(
    spark: SparkSession, database: str, expected: tuple[LandingFile, ...], log: DataFrame
) -> DataFrame:
    """(table, bronze, raw, match) against the latest check of each file. Rows in
    quarantine count as arrived."""
    latest = log.groupBy("system", "file").agg(F.max_by("rows", "checked_at").alias("raw"))
    counts = reduce(DataFrame.unionByName, [
        _kept_and_rejected(spark, f"{database}.{f.table}").agg(F.count(F.lit(1)).alias("bronze")).select(
            F.lit(f.table).alias("table"), F.lit(f.system).alias("system"), F.lit(f.file).alias("file"), "bronze"
        )
        for f in expected
    ])
    return counts.join(latest, ["system", "file"], "left").select(
        "table", "bronze", "raw", F.coalesce(F.col("bronze") == F.col("raw"), F.lit(False)).alias("match")
    )


def reconcile_gate(result: DataFrame) -> DataFrame:
    bad = sorted(r["table"] for r in result.where(~F.col("match")).collect())
    if bad:
        raise CheckFailed("row counts differ from the landing files: " + ", ".join(bad))
    return result


def raw_frame(spark: SparkSession, database: str, file: LandingFile) -> DataFrame:
    """A bronze table under the column names the typed layer uses."""
    bronze = spark.table(f"{database}.{file.table}")
    absent = [c for c in file.columns if c not in bronze.columns]
    if absent:
        raise CheckFailed(f"{file.file} lacks the columns {', '.join(absent)}")
    return bronze.select(*[F.col(source).alias(name) for source, name in file.columns.items()])


# -- fixtures ------------------------------------------------------------------------

def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    suffix = os.path.splitext(path)[1].lower()
    if suffix == ".json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == ".csv":
        return scan_csv_text(spark, path)
    raise ValueError(f"a fixture is .json or .csv, not {suffix or 'without suffix'}")
