"""Row filters, column masks and policies as DataFrame operators.

Who is asking is an explicit ``Principal`` argument (user, groups, tenant);
nothing reads the OS user. Filters and masks are plain Column expressions, so
they are pushed down and stay in generated code. Policies are allow-only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.masking import apply_mask, mask_cpf, mask_email

# Fixed value: the group that sees everything unmasked.
ADMIN_GROUP = "admins"


@dataclass(frozen=True)
class Principal:
    user: str
    groups: frozenset = field(default_factory=frozenset)
    tenant: str | None = None

    def member(self, group: str) -> bool:
        return group in self.groups


def _pred(p) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def row_filter(df: DataFrame, principal: Principal, predicate, unless_group: str = ADMIN_GROUP) -> DataFrame:
    """Members of ``unless_group`` see every row; others only rows matching ``predicate``."""
    if principal.member(unless_group):
        return df
    return df.filter(F.coalesce(_pred(predicate), F.lit(False)))


def mask_column(df: DataFrame, col: str, principal: Principal, method: str, unmasked_group: str = ADMIN_GROUP,
                salt: str | None = None) -> DataFrame:
    if principal.member(unmasked_group):
        return df
    return df.withColumn(col, apply_mask(method, F.col(col), salt))


def secure_customers(df: DataFrame, principal: Principal) -> DataFrame:
    """The lab's secure view: row filter uf = 'SP', CPF and e-mail masked for non-admins."""
    out = row_filter(df, principal, F.col("uf") == "SP")
    if not principal.member(ADMIN_GROUP):
        out = out.withColumn("cpf", mask_cpf("cpf")).withColumn("email", mask_email("email"))
    return out


def tagged_columns(df: DataFrame, tag: str = "pii") -> dict[str, str]:
    """Columns carrying ``tag`` in their StructField metadata -> the tag's value (mask method)."""
    return {f.name: f.metadata[tag] for f in df.schema.fields if tag in (f.metadata or {})}


def tag_columns(df: DataFrame, tags: dict[str, str], tag: str = "pii") -> DataFrame:
    """Attach a classification tag to columns (kept in the schema metadata)."""
    return df.select(*[F.col(c).alias(c, metadata={tag: tags[c]}) if c in tags else F.col(c) for c in df.columns])


def apply_policy(df: DataFrame, policy: dict, principal: Principal) -> DataFrame:
    """Apply a policy in one projection and one filter.

    policy = {
      "columns": {col: {"method": m, "unmasked_for": [groups], "salt": s}},
      "tagged": {"tag": "pii", "unmasked_for": [groups], "salt": s},   # masks from schema tags
      "row_filters": [{"predicate": sql, "unless": [groups]}],
    }
    Column rules listed explicitly win over tag-derived ones. The mask ``hash`` without a salt is an error.
    """
    rules = {}
    tagged = policy.get("tagged")
    if tagged:
        for c, m in tagged_columns(df, tagged.get("tag", "pii")).items():
            rules[c] = {"method": m, "unmasked_for": tagged.get("unmasked_for", [ADMIN_GROUP]), "salt": tagged.get("salt")}
    rules.update(policy.get("columns", {}))
    proj = []
    for c in df.columns:
        r = rules.get(c)
        if r and not any(principal.member(g) for g in r.get("unmasked_for", [ADMIN_GROUP])):
            proj.append(apply_mask(r["method"], F.col(c), r.get("salt")).alias(c))
        else:
            proj.append(F.col(c))
    cond = None
    for rf in policy.get("row_filters", []):
        if any(principal.member(g) for g in rf.get("unless", [ADMIN_GROUP])):
            continue
        p = F.coalesce(_pred(rf["predicate"]), F.lit(False))
        cond = p if cond is None else (cond & p)
    # Row filters see the stored values; masks apply to what passes.
    return (df.filter(cond) if cond is not None else df).select(*proj)


def tenant_filter(df: DataFrame, principal: Principal, tenant_col: str = "tenant_id",
                  unless_group: str = ADMIN_GROUP) -> DataFrame:
    """Tenant isolation: a principal sees only its tenant's rows."""
    if principal.member(unless_group):
        return df
    if principal.tenant is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(tenant_col) == F.lit(principal.tenant))


def erase_subjects(df: DataFrame, subjects: DataFrame, key: str, subject_key: str | None = None) -> DataFrame:
    """Right to erasure / opt-out: drop every row of the listed subjects (anti-join).

    The subject list is joined, never collected; it is shuffled with the data or
    broadcast by AQE when small.
    """
    s = subjects.select(F.col(subject_key or key).alias(key)).distinct()
    return df.join(s, on=key, how="left_anti")
