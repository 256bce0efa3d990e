r"""Secret scans with corpus-wide ownership frequency (operator 4), in SQL expressions only.

``split`` and ``regexp_extract_all`` cut a text by the same pattern into gaps and matches, whose running
lengths are the spans' code-point positions.  Base kinds are reported as found.  Every candidate value is
hashed and counted over the corpus by distinct owners and by distinct repositories: a value that several owners
hold, or that one owner has in more than ``live_repositories`` repositories, is a copied example; the others look
live.  The method adds ``generic`` spans: random-looking values that no base span covers and that look live.

An owner is a source, a repository a source's documents in one language; both are parameters.

Defined cases: a null or empty text has no spans; very long texts are scanned whole; null repositories and
owners count as one more name each; repeated rows give repeated rows and count as one repository; an empty
table gives no rows; ``masked`` returns all columns of its input, whatever their names, ``op4`` its own only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stash

#: The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
#: Runs that may be keys without a name beside them; mixed digits, capitals and small letters are asked for besides.
GENERIC = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "generic")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: int, pattern: str, test: str, group: int = 0) -> str:
    """Array of structs of the matches whose value passes ``test``; texts without a match skip the work."""
    p = _quoted(pattern)
    values = f"regexp_extract_all(t, {p}, {group})" if group else "m"
    body = f"""transform(array(named_struct('g', split(t, {p}, -1), 'm', regexp_extract_all(t, {p}, 0))), x ->
        transform(array(named_struct('m', x.m, 'v', {values.replace("m", "x.m") if not group else values})), y ->
            aggregate(sequence(1, size(y.m)), named_struct('at', 0, 'out', cast(array() as array<struct<start:int,ord:int,end:int,value:string>>)),
                (a, i) -> named_struct('at', a.at + length(x.g[i - 1]) + length(y.m[i - 1]), 'out', if({test.replace("value", "y.v[i - 1]")},
                    concat(a.out, array(named_struct('start', a.at + length(x.g[i - 1]), 'ord', {kind}, 'end', a.at + length(x.g[i - 1]) + length(y.m[i - 1]), 'value', y.v[i - 1]))), a.out)),
                a -> a.out))[0])[0]"""
    return f"if(t rlike {p}, {body}, cast(array() as array<struct<start:int,ord:int,end:int,value:string>>))"


_LISTED = "array_join(transform(array_sort({}), x -> concat(element_at(array('assign', 'access', 'hex', 'generic'), x.ord + 1), ':', x.start, ':', x.end)), ',')"


#: Owners and repositories of each candidate, in order of place; generic ones that do not look live are listed too.
_FREQUENCY = "coalesce(array_join(transform(array_sort(seen), x -> concat(element_at(array('assign', 'access', 'hex', 'generic'), x.ord + 1), ':', x.start, ':', x.owners, '/', x.repositories)), ','), '')"


def _found() -> Column:
    mixed = "value rlike '[0-9]' and value rlike '[a-z]' and value rlike '[A-Z]'"
    return F.expr(f"""transform(array(coalesce(cast(_t as string), '')), t -> named_struct(
        'assign', {_spans(0, ASSIGN, "length(value) >= 12", 2)},
        'access', {_spans(1, ACCESS, "true")},
        'hex', {_spans(2, HEX, "true")},
        'generic', {_spans(3, GENERIC, mixed)}))[0]""")


def scan(docs: DataFrame, repository: tuple = ("source", "lang"), owner: tuple = ("source",), keep: Column | None = None) -> DataFrame:
    """One row a text: row, doc (``keep``), doc_id, repo, owner, base spans and uncovered generic spans, as structs with hashed
    values.  Row numbers hold once the result is written."""
    hashed = "transform({}, x -> named_struct('start', x.start, 'ord', x.ord, 'end', x.end, 'hash', sha2(x.value, 256)))"
    name = lambda columns: F.concat_ws("\1", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    named = docs.select(F.monotonically_increasing_id().alias("row"), (F.lit(0) if keep is None else keep).alias("doc"), "doc_id", name(repository).alias("repo"), name(owner).alias("owner"), F.col("text").alias("_t"))
    found = named.select("row", "doc", "doc_id", "repo", "owner", _found().alias("f"))
    base = found.select("row", "doc", "doc_id", "repo", "owner", "f.assign", "f.access", "f.hex", "f.generic")
    base = base.select(
        "row", "doc", "doc_id", "repo", "owner",
        F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
        F.expr("concat(assign, access, hex)").alias("base"), "generic",
    )
    free = "filter(generic, g -> not exists(base, b -> b.start < g.end and g.start < b.end))"
    return base.select("row", "doc", "doc_id", "repo", "owner", "n_assign", "n_access", "n_hex", F.expr(hashed.format("base")).alias("base"), F.expr(hashed.format(free)).alias("generic"))


def judged(scanned: DataFrame, live_owners: int = 1, live_repositories: int = 2) -> DataFrame:
    """Candidates of ``scanned``, which is written, one row each: row, start, ord, end, owners, repositories and ``live``."""
    each = scanned.select("row", "repo", "owner", F.explode(F.concat("base", "generic")).alias("s")).select("row", "repo", "owner", "s.*")
    # one row a (value, owner, repository) before the counts: copies of a value are combined before they move
    held = each.select("hash", "repo", "owner").distinct().groupBy("hash")
    # written, so that a value in very many rows is a skewed join of two scans, which Spark splits
    counts = stash(held.agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repo").alias("repositories")), "owners")
    live = F.expr(f"owners <= {int(live_owners)} and repositories <= {int(live_repositories)}")
    return each.join(counts, "hash").select("row", "start", "ord", "end", "owners", "repositories", live.alias("live"))


_PLACES = "transform(base, x -> named_struct('start', x.start, 'ord', x.ord, 'end', x.end))"
_ADDED = "coalesce(added, cast(array() as array<struct<start:int,ord:int,end:int>>))"


def report(docs: DataFrame) -> DataFrame:
    scanned = stash(scan(docs), "secrets")
    by_row = judged(scanned).groupBy("row").agg(
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        F.collect_list(F.when(F.col("live") & (F.col("ord") == 3), F.struct("start", "ord", "end"))).alias("added"),
        F.collect_list(F.struct("start", "ord", "end", "owners", "repositories")).alias("seen"),
    )
    found = scanned.join(by_row, "row", "left").withColumns({"base": F.expr(_PLACES), "added": F.expr(_ADDED)})
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.expr(_LISTED.format("base")), 256).alias("base_sha256"),
        F.expr(_LISTED.format("concat(base, added)")).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"), F.expr(_FREQUENCY).alias("frequency"),
    )


def masked(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; texts without spans are untouched."""
    held = stash(scan(docs, keep=F.struct(*[F.col(f"`{c}`") for c in docs.columns])), "secrets")
    # only rows with spans that the counts add meet another table; Spark broadcasts it only if its file is under its threshold
    added = stash(judged(held).where("live and ord = 3").groupBy("row").agg(F.collect_list(F.struct("start", "ord", "end")).alias("added")), "added")
    spans = held.select("row", "doc", F.expr(_PLACES).alias("base")).join(added, "row", "left").select("doc", F.expr(f"array_sort(concat(base, {_ADDED}))").alias("_spans"))
    # overlapping spans leave one mark: a span that begins inside what is masked only moves its end
    cut = """aggregate(_spans, named_struct('at', 0, 'out', ''), (a, x) -> if(x.start < a.at, named_struct('at', greatest(a.at, x.end), 'out', a.out),
        named_struct('at', x.end, 'out', concat(a.out, substring(doc.text, a.at + 1, x.start - a.at), '{}'))), a -> concat(a.out, substring(doc.text, a.at + 1)))"""
    done = spans.select("doc", F.expr(f"if(size(_spans) = 0, doc.text, {cut.format(mark)})").alias("_text"))
    return done.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(documents(spark, sf_dir))
