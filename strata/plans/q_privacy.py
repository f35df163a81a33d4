"""Privacy queries: row filters, masks, secure view, pseudonyms, policies, tenants, erasure."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import masking as K
from strata.functions.hashing import salted_sha256
from strata.operators import privacy as PV
from strata.operators.sinks import write_partitioned
from strata.operators.stored import erase_from, read_stored
from strata.plans import views as V
from strata.plans.q_cdc import CDC_COLS_SQL, STG_SQL, cdc_scd1
from strata.plans.registry import query
from strata.session import work_path

ANALYST = PV.Principal("ana", frozenset({"analysts"}), tenant="BUILDING")
ADMIN = PV.Principal("root", frozenset({"admins"}))
SALT = "s4lt"

CURRENT_SQL = V.with_views(f""", {STG_SQL},
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC NULLS LAST, event_id)
           AS rn FROM stg) WHERE rn = 1),
clientes_atual AS (SELECT {CDC_COLS_SQL} FROM latest WHERE operacao <> 'DELETE')
{{body}}""", "clientes_cdc")


def clientes_atual(spark, d):
    return cdc_scd1(spark, d).select("cliente_id", "nome", "uf", "segmento", "email", "cpf")


@query("prv_row_filter", CURRENT_SQL.format(body="SELECT cliente_id, nome, uf, segmento, email, cpf FROM clientes_atual WHERE uf = 'SP'"))
def prv_row_filter(spark, d):
    """PRV-1: non-admins see only uf = 'SP'."""
    return PV.row_filter(clientes_atual(spark, d), ANALYST, F.col("uf") == "SP")


@query("prv_row_filter_admin", CURRENT_SQL.format(body="SELECT cliente_id, nome, uf, segmento, email, cpf FROM clientes_atual"))
def prv_row_filter_admin(spark, d):
    """PRV-1: admins see every row."""
    return PV.row_filter(clientes_atual(spark, d), ADMIN, F.col("uf") == "SP")


@query("prv_mask_cpf", CURRENT_SQL.format(body="SELECT cliente_id, '***.***.***-' || right(cpf, 2) AS cpf FROM clientes_atual"))
def prv_mask_cpf(spark, d):
    """PRV-2: CPF masked to its last two characters for non-admins."""
    return PV.mask_column(clientes_atual(spark, d), "cpf", ANALYST, "cpf").select("cliente_id", "cpf")


@query("prv_secure_view", CURRENT_SQL.format(body="""SELECT cliente_id, nome, uf, segmento,
  regexp_replace(email, '^[^@]+', '***') AS email, '***.***.***-' || right(cpf, 2) AS cpf FROM clientes_atual WHERE uf = 'SP'"""))
def prv_secure_view(spark, d):
    """PRV-3: secure view (row filter + e-mail and CPF masks)."""
    return PV.secure_customers(clientes_atual(spark, d), ANALYST)


@query("prv_hash", CURRENT_SQL.format(body=f"SELECT cliente_id, sha256(email || '{SALT}') AS email_hash FROM clientes_atual"))
def prv_hash(spark, d):
    """PRV-4: salted SHA-256 pseudonym."""
    c = clientes_atual(spark, d)
    return c.select("cliente_id", salted_sha256("email", SALT).alias("email_hash"))


@query("prv_last4", """
SELECT c_custkey, '********' || right(c_phone, 4) AS fixo, repeat('*', length(c_phone) - 4) || right(c_phone, 4) AS mesmo_tamanho,
       '***-**-' || right(c_phone, 4) AS ssn FROM (SELECT c_custkey, CAST(9000000000 + c_custkey AS VARCHAR) AS c_phone FROM customer)""")
def prv_last4(spark, d):
    """PRV-5: keep-last-4 masks (fixed stars, length-preserving, SSN form)."""
    c = V.table(spark, d, "customer").select("c_custkey", (F.lit(9_000_000_000) + F.col("c_custkey")).cast("string").alias("c_phone"))
    return c.select("c_custkey", K.keep_last4("c_phone").alias("fixo"), K.keep_last4_same_length("c_phone").alias("mesmo_tamanho"),
                    K.mask_ssn("c_phone").alias("ssn"))


@query("prv_subnet", f"""
SELECT event_id, CAST(10 + event_id % 200 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) || '.' ||
       CAST(event_id % 256 AS VARCHAR) || '.0' AS subnet FROM events""")
def prv_subnet(spark, d):
    """PRV-6: IPv4 address reduced to its /24 subnet."""
    e = V.table(spark, d, "events")
    ip = F.concat_ws(".", (10 + F.col("event_id") % 200).cast("string"), (F.col("user_id") % 256).cast("string"),
                     (F.col("event_id") % 256).cast("string"), ((F.col("event_id") * 7) % 256).cast("string"))
    return e.select("event_id", K.ip_subnet(ip).alias("subnet"))


POLICY = {
    "tagged": {"tag": "pii", "unmasked_for": ["admins", "privacy_officers"], "salt": SALT},
    "columns": {"nome": {"method": "redact", "unmasked_for": ["admins", "support"]}},
    "row_filters": [{"predicate": "segmento = 'varejo'", "unless": ["admins", "private_banking"]}],
}


@query("prv_policy", CURRENT_SQL.format(body=f"""SELECT cliente_id, CASE WHEN nome IS NOT NULL THEN 'REDACTED' END AS nome, uf, segmento,
  regexp_replace(email, '^[^@]+', '***') AS email, sha256(cpf || '{SALT}') AS cpf FROM clientes_atual WHERE segmento = 'varejo'"""))
def prv_policy(spark, d):
    """PRV-7: one policy (tags in the schema + explicit columns + role row filters) applied in one pass."""
    c = PV.tag_columns(clientes_atual(spark, d), {"email": "email", "cpf": "hash"})
    return PV.apply_policy(c, POLICY, ANALYST)


@query("prv_tenant", """
SELECT o_orderkey, o_custkey, c_mktsegment AS tenant_id, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING'""")
def prv_tenant(spark, d):
    """PRV-8: tenant isolation (tenant = market segment of the ordering customer)."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("tenant_id"))
    return PV.tenant_filter(o.join(c, "o_custkey"), ANALYST).select("o_orderkey", "o_custkey", "tenant_id", "o_totalprice")


@query("prv_erase", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def prv_erase(spark, d):
    """PRV-9: right to erasure / opt-out: every order of the listed customers removed from the stored table's files."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.date_trunc("month", "o_orderdate").cast("date").alias("month"))
    path = work_path(spark, "orders-with-subjects")
    write_partitioned(o, path, ["month"])
    subjects = V.table(spark, d, "customer").filter(F.col("c_acctbal") < 0)  # opted-out subjects
    erase_from(spark, path, subjects, "o_custkey", "c_custkey", ["month"])
    return read_stored(spark, path).select("o_orderkey", "o_custkey", "o_totalprice")
