"""Loaders: the driver tables, and the catalog views the queries run on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = "slug string, jenis string, nomor string, tahun int, tentang string, status string, pemrakarsa string, pdf_url string, local_path string, published timestamp, price double, owner bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalog records: one row per slug."""
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ord-"), key).alias("slug"),
        F.col("o_orderpriority").alias("jenis"),
        (key % 997).cast("string").alias("nomor"),
        F.year("o_orderdate").alias("tahun"),
        F.concat(F.lower("o_orderpriority"), F.lit(" order of customer "), owner).alias("tentang"),
        F.when(F.col("o_orderstatus") == "F", "Berlaku").when(F.col("o_orderstatus") == "O", "Tidak Berlaku").alias("status"),
        F.when(owner % 13 == 0, "").when(owner % 17 == 0, None).otherwise(F.concat(F.lit("agency "), owner % 40)).alias("pemrakarsa"),
        F.when(key % 7 == 0, None).when(key % 11 == 0, "NO_PDF").otherwise(F.concat(F.lit("/files/"), key, F.lit(".pdf"))).alias("pdf_url"),
        F.when(key % 3 == 0, F.concat(F.lit("/data/"), key, F.lit(".pdf"))).alias("local_path"),
        F.col("o_orderdate").alias("published"),
        F.col("o_totalprice").alias("price"),
        owner.alias("owner"),
    )


#: The same view for the SQL oracle, to stand after WITH.
CATALOG_SQL = """catalog as (
  select 'ord-' || o_orderkey as slug, o_orderpriority as jenis, (o_orderkey % 997)::varchar as nomor, year(o_orderdate)::int as tahun,
    lower(o_orderpriority) || ' order of customer ' || o_custkey as tentang,
    case o_orderstatus when 'F' then 'Berlaku' when 'O' then 'Tidak Berlaku' end as status,
    case when o_custkey % 13 = 0 then '' when o_custkey % 17 = 0 then null else 'agency ' || (o_custkey % 40) end as pemrakarsa,
    case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then 'NO_PDF' else '/files/' || o_orderkey || '.pdf' end as pdf_url,
    case when o_orderkey % 3 = 0 then '/data/' || o_orderkey || '.pdf' end as local_path,
    o_orderdate as published, o_totalprice as price, o_custkey as owner
  from orders)"""


def lines_of(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per line of each document: keep columns, pos, line."""
    return docs.select(*keep, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def _pick(selector: str, values: list[str]) -> str:
    """A CASE over the numbers from 0 on."""
    return f"case {selector} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


# Kinds of laws with their short codes, and month names.
LAW_KINDS = ["Undang-Undang", "Peraturan Pemerintah", "Peraturan Presiden", "Peraturan Menteri", "Peraturan Pemerintah Pengganti Undang-Undang"]
LAW_CODES = ["UU", "PP", "PERPRES", "PERMEN", "PERPPU"]
MONTH_NAMES = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]

_quoted = lambda names: [f"'{x}'" for x in names]
_LAW_FIELDS = f"""o_orderkey as k, o_custkey as c, cast(year(o_orderdate) as int) as y, cast(o_orderkey % 997 as int) as n,
  cast(cast(o_orderdate as date) as string) as published,
  {_pick("cast(o_orderkey % 5 as int)", _quoted(LAW_KINDS))} as kind, {_pick("cast(o_orderkey % 5 as int)", _quoted(LAW_CODES))} as code,
  {_pick("cast(o_custkey % 5 as int)", _quoted(LAW_KINDS))} as ref_kind, {_pick("cast(o_custkey % 5 as int)", _quoted(LAW_CODES))} as ref_code,
  cast(o_custkey % 300 + 1 as int) as ref_number, cast(1960 + o_orderkey % 40 as int) as ref_year,
  cast(o_orderkey % 28 + 1 as int) as day, cast(o_custkey % 12 as int) as month_at,
  {_pick("cast(o_custkey % 12 as int)", _quoted(MONTH_NAMES))} as month_name"""
_LAW_REF = "concat(ref_kind, ' Nomor ', cast(ref_number as string), ' Tahun ', cast(ref_year as string))"
_LAW_CLAUSES = [
    "concat(ref, ' dicabut dan dinyatakan tidak berlaku')",
    "concat('Perubahan atas ', ref, ' ditetapkan lagi')",
    "concat('Semua izin dinyatakan masih tetap berlaku sepanjang tidak bertentangan dengan ', ref, ' ini')",
    "concat('Izin menurut ', ref, ' tetap berlaku sampai dengan ditetapkannya izin baru oleh menteri')",
    "concat('Untuk melaksanakan ketentuan Pasal 5 ayat (2) ', ref, ', perlu aturan')",
    "'Tidak ada rujukan di sini sama sekali'",
]
_LAW_ENTRIES = [
    "'Peraturan ini mulai berlaku pada tanggal diundangkan.'",
    "concat('Peraturan ini mulai berlaku pada tanggal ', cast(day as string), ' ', month_name, ' ', cast(y as string), '.')",
    "concat('Peraturan ini mulai berlaku ', cast(day as string), ' (', cast(day as string), ') hari sejak tanggal diundangkan.')",
    "'Peraturan ini mulai berlaku dua belas bulan setelah tanggal diundangkan.'",
    "'Peraturan ini mulai berlaku setelah Keputusan Menteri ditetapkan.'",
    "concat('Peraturan ini mulai berlaku surut sejak tanggal ', cast(day as string), ' ', month_name, ' ', cast(y as string), '.')",
    "'Selesai.'",
]
_LAW_HEAD = "concat(upper(kind), ' NOMOR ', cast(n as string), ' TAHUN ', cast(y as string), ' TENTANG POKOK ', cast(c as string), chr(10), chr(10))"
_LAW_BODY = (
    "concat('BAB I', chr(10), 'KETENTUAN UMUM', chr(10), 'Pasal 1', chr(10), '(1) Jenis:', chr(10), 'a. logam', chr(10), 'b. bukan logam', chr(10), '(2) Endapan sebagaimana dimaksud dalam Pasal ', cast(k % 9 + 1 as string), ' ayat (', cast(k % 4 + 1 as string), ') huruf b.', chr(10), "
    "'Pasal 2', chr(10), clause, '.', chr(10), 'BAB II', chr(10), 'PENUTUP', chr(10), 'Pasal 3', chr(10), entry, chr(10))"
)
_LAW_STEPS = [
    (_LAW_FIELDS, "orders"),
    (f"*, concat('law-', cast(k as string)) as slug, cast(k % 6 as int) as clause_at, cast(k % 7 as int) as entry_at, {_LAW_REF} as ref, concat(lower(ref_code), '-no-', cast(ref_number as string), '-tahun-', cast(ref_year as string)) as ref_slug", "law0"),
    (f"*, {_pick('clause_at', _LAW_CLAUSES)} as clause, {_pick('entry_at', _LAW_ENTRIES)} as entry", "law1"),
    (f"*, {_LAW_HEAD} as head, {_LAW_BODY} as body", "law2"),
    ("*, concat(head, 'Menimbang', chr(10), 'bahwa perlu;', chr(10), 'MEMUTUSKAN:', chr(10), body, 'Ditetapkan di Jakarta') as text", "law3"),
]
#: Laws for the SQL oracle, to stand after WITH; ``laws`` runs the same steps.
LAWS_SQL = ", ".join(f"{name} as (select {step} from {source})" for (step, source), name in zip(_LAW_STEPS, ["law0", "law1", "law2", "law3", "laws"], strict=True))


def laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as texts of laws: a head, three articles in two chapters, a clause
    that refers to another law, and one on the entry into force.  The text is made
    from columns that stand beside it, so what is read from it can be told from them."""
    return reduce(lambda df, step: df.selectExpr(*_columns(step[0])), _LAW_STEPS, table(spark, sf_dir, "orders"))


def _columns(step: str) -> list[str]:
    """The select list, cut at commas outside of parentheses and quotes."""
    out, depth, quoted = [""], 0, False
    for ch in step:
        if ch == "'":
            quoted = not quoted
        elif not quoted:
            depth += (ch == "(") - (ch == ")")
        if ch == "," and not quoted and depth == 0:
            out.append("")
        else:
            out[-1] += ch
    return [x.strip() for x in out]
