"""Secret scans: candidates in texts, weighed by how widely each value is owned across the corpus.

All work is DataFrame expressions. ``candidates`` finds key assignments, access keys and long hexadecimal strings (the
base kinds) and opaque tokens (long strings mixing letters and digits) with their places. ``ownership`` counts, for the
hash of each candidate value, the distinct owners and repositories that hold it, pre-aggregated so that a widely copied
value never meets in one task. A value with more than ``max_owners`` owners is a copied example; the others are
owner-specific and look live. Base spans are always reported; the method adds the opaque tokens that look live, where
no base span covers them.

Places are code points. Matches are found with ``regexp_extract_all`` and their places with ``split`` by the same
pattern: a match starts where the pieces and matches before it end.

Defined cases: a null text is an empty text. A null owner or repository is one of its own. Rows equal in id and text are
one document (each input row still gets its result); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import stored, table, unused

# The patterns of the base kinds, in the order in which spans that start together are listed.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
OPAQUE = r"[A-Za-z0-9+/_-]+"
KINDS = ("assign", "access", "hex", "opaque")
#: Quick tests that every text with a match of the kind passes; the others are not searched further.
_MAY = {
    "assign": r"[pP][aA][sS][sS][wW]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "opaque": r"[A-Za-z0-9+/_-]{24}",
}
#: A text's runs of a class are searched only where one of the least length begins, so short runs cost nothing.
_LONG = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}", "opaque": r"[A-Za-z0-9+/_-]{24,}"}


def _found(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, value>> of one kind; places are code points, end exclusive.

    For kinds that are runs of one class, a leftmost run of at least the least length is the same as a run that is long
    enough; for assignments the length of the value is tested afterwards, as a failing match still uses up its text.
    """
    pattern = F.lit(_LONG.get(kind, ASSIGN))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else matches
    lengths = F.transform(matches, F.length)
    gaps = F.transform(F.split(text, _LONG.get(kind, ASSIGN), -1), F.length)
    # (place after the last match, spans so far), one step per match
    steps = F.arrays_zip(lengths.alias("size"), F.slice(gaps, 1, F.size(matches)).alias("gap"), values.alias("value"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                F.lit(kind).alias("kind"), (acc["at"] + s["gap"]).alias("start"),
                (acc["at"] + s["gap"] + s["size"]).alias("end"), s["value"].alias("value")))).alias("spans")))["spans"]
    if kind == "assign":
        walked = F.filter(walked, lambda s: F.length(s["value"]) >= 8)
    if kind == "opaque":
        walked = F.filter(walked, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return F.when(text.rlike(_MAY[kind]), walked).otherwise(empty)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """One row per candidate: id, text_key (hash of the text), owner, repository, kind, start, end, value_key (hash)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), owner.cast("string").alias("owner"),
                        repository.cast("string").alias("repository"),
                        F.concat(*[_found(text, k) for k in KINDS]).alias("spans")).where(F.size("spans") > 0)
    return spans.select("id", "text_key", "owner", "repository", F.explode("spans").alias("s")).select(
        "id", "text_key", "owner", "repository", "s.kind", "s.start", "s.end", F.xxhash64("s.value").alias("value_key"))


def ownership(found: DataFrame) -> DataFrame:
    """(value_key, owners, repositories): distinct owners and repositories of each value over the corpus."""
    by_holder = found.select("value_key", F.struct("owner").alias("o"), F.struct("owner", "repository").alias("r")).distinct()
    first = by_holder.groupBy("value_key", "o").agg(F.count("*").alias("repositories"))
    return first.groupBy("value_key").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
         repository: Column | None = None, max_owners: int = 2) -> DataFrame:
    """(id, text_key, spans): every reported span with its kind, place, whether it ``live``-looks, owners and repositories.

    Spans are sorted by start, then by kind as listed; documents without spans are not in the result.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("source") if repository is None else repository
    found = stored(candidates(docs, id_col, text_col, owner, repository), "secrets-candidates")  # one pass over the texts
    kept = found.select("id", "text_key", "kind", "start", "end", "value_key").distinct().join(ownership(found), "value_key")
    listed = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int")
    rows = kept.groupBy("id", "text_key").agg(F.sort_array(F.collect_list(F.struct(
        "start", listed.alias("nr"), "kind", "end", (F.col("owners") <= max_owners).alias("live"), "owners", "repositories"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] != "opaque")
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return (rows.withColumn("base", base)
            .withColumn("spans", F.filter("all", lambda s: (s["kind"] != "opaque") | (s["live"] & free(s))))
            .select("id", "text_key", "spans").where(F.size("spans") > 0))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
           repository: Column | None = None, max_owners: int = 2) -> DataFrame:
    """One row per input row: counts of the base kinds, digest of the base spans, all spans as text, live and copied counts."""
    spans = scan(docs, id_col, text_col, owner, repository, max_owners)
    keys = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__key"))
    joined = keys.join(spans, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__key") == F.col("text_key")), "left")
    own = F.coalesce(F.col("spans"), F.expr(f"cast(array() as {dict(spans.dtypes)['spans']})"))
    text = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("long")
    return joined.select(
        F.col("__id").alias(id_col), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(F.filter(own, lambda s: s["kind"] != "opaque")).cast("binary"), 256).alias("base_sha256"), text(own).alias("spans"),
        F.size(F.filter(own, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(own, lambda s: ~s["live"])).cast("long").alias("n_copied"))


def mask_live(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
              repository: Column | None = None, max_owners: int = 2, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live-looking span replaced by ``mark``; copied examples stay. Columns and rows stay as they are."""
    spans = scan(docs, id_col, text_col, owner, repository, max_owners)
    own = unused(docs.columns)
    live = spans.select(F.col("id").alias(f"{own}span_id"), F.col("text_key").alias(f"{own}span_key"), F.filter("spans", lambda s: s["live"]).alias(f"{own}live")
                        ).where(F.size(f"{own}live") > 0)
    text = F.col(text_col)
    joined = docs.join(live, F.col(id_col).eqNullSafe(F.col(f"{own}span_id"))
                       & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(f"{own}span_key")), "left")
    # from left to right: text between the spans, a mark for each span (or run of spans that overlap)
    walked = F.aggregate(f"{own}live", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out")))
    masked = F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))
    return joined.select(*[F.when(F.col(f"{own}live").isNull(), text).otherwise(masked).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the owner is the source, the repository the source with its language."""
    docs = table(spark, sf_dir, "documents")
    return report(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))


_SPANS_SQL = """
    (select doc_id, kind, nr, list_transform(range(1, len(m) + 1), lambda i: {{
                'start': (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::int,
                'size': length(m[i]), 'value': v[i]}}) as found
     from (select doc_id, '{kind}' as kind, {nr} as nr, regexp_extract_all(t, '{pattern}') as m,
                  regexp_extract_all(t, '{pattern}', {group}) as v, string_split_regex(t, '{pattern}') as g from texts))"""


def _spans_sql(kind: str, nr: int, pattern: str, group: int) -> str:
    return _SPANS_SQL.format(kind=kind, nr=nr, pattern=pattern.replace("'", "''"), group=group)


SQL = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as (
  select doc_id, kind, nr, unnest(found) as f from (
    {" union all ".join(_spans_sql(k, i + 1, _LONG.get(k, ASSIGN), 2 if k == "assign" else 0) for i, k in enumerate(KINDS))})),
spans as (
  select doc_id, kind, nr, f.start as a, f.start + f.size as b, f.value as value from found
  where case kind when 'assign' then length(f.value) >= 8
                  when 'opaque' then regexp_matches(f.value, '[0-9]') and regexp_matches(f.value, '[A-Za-z]') else true end),
held as (
  select value, count(distinct coalesce(source, '~null')) as owners from spans join documents using (doc_id) group by value),
reported as (
  select s.*, h.owners <= 2 as live from spans s join held h using (value)
  where s.kind <> 'opaque' or (h.owners <= 2 and not exists (
    select 1 from spans b where b.doc_id = s.doc_id and b.kind <> 'opaque' and b.a < s.b and s.a < b.b)))
select d.doc_id,
       count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
       sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, nr) filter (kind <> 'opaque'), '')) as base_sha256,
       coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, nr), '') as spans,
       count(*) filter (live) as n_live, count(*) filter (not live) as n_copied
from documents d left join reported r on r.doc_id = d.doc_id group by d.doc_id
"""
