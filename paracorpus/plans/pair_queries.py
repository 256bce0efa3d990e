"""Queries over vectors, beads, pairs, the deliverable and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..operators import align, evaluate, export
from ..sources import files
from . import text_queries as TQ
from .registry import query, table

WS = T.RE2_WS


def _one_row(*frames):
    """One-row frames side by side: their columns are stacked and each takes its only value."""
    names = [c for f in frames for c in f.columns]
    kinds = {x.name: x.dataType for f in frames for x in f.schema}
    rows = [f.select(*[F.col(c) if c in f.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names]) for f in frames]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.agg(*[F.max(c).alias(c) for c in names])


def embeddings(spark, sf_dir):
    """(side, idx, embedding): even rows are the source side, odd rows the target side."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.when(F.col("vec_id") % 2 == 0, "src").otherwise("tgt").alias("side"), F.expr("vec_id div 2").alias("idx"), "embedding")


def side(spark, sf_dir, name):
    return embeddings(spark, sf_dir).where(F.col("side") == name).select("idx", "embedding")


SIDES_SQL = "sides as (select case when vec_id % 2 = 0 then 'src' else 'tgt' end as side, vec_id // 2 as idx, cast(embedding as double[]) as v from embeddings)"


@query("select vec_id, cast(len(embedding) as bigint) as dim, round(list_sum(list_transform(embedding, lambda x: cast(x as double))), 6) as total from embeddings")
def scan_embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.size("embedding").cast("long").alias("dim"), V.rounded(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))).alias("total"))


@query("select doc_id as idx, text from documents")
def jsonl_roundtrip(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), "text")
    path = files.scratch(spark, "jsonl")
    files.write_jsonl(d, path)
    return files.read_sentences(spark, path)


@query("with t as (select case when doc_id % 2 = 0 then 'src' else 'tgt' end as side, doc_id // 2 as idx, text from documents) select side, idx, text from t")
def union_sides(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    part = lambda r, name: d.where(F.col("doc_id") % 2 == r).select(F.lit(name).alias("side"), F.expr("doc_id div 2").alias("idx"), "text")
    return part(0, "src").unionByName(part(1, "tgt"))


_DEDUP = f"""select doc_id % 2 as side, min(doc_id) as idx, t as text from (select doc_id, regexp_replace(translate(text, chr(10) || chr(13), '  '), '^{WS}+|{WS}+$', '', 'g') as t from documents)
    where length(t) >= 3 group by doc_id % 2, t"""


@query(_DEDUP)
def dedup_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 2).alias("side"), F.col("doc_id").alias("idx"), "text")
    return align.dedup_keep_first(d, side=["side"])


@query(f"with {SIDES_SQL}, k as ({_DEDUP}) select k.idx, round(v[1], 6) as first from k join sides on sides.idx = k.idx and sides.side = 'src' where k.side = 0")
def join_embed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("idx"), "text")
    return align.dedup_keep_first(d).join(side(spark, sf_dir, "src"), "idx").select("idx", V.rounded(F.get("embedding", F.lit(0)).cast("double")).alias("first"))


@query("with t as (select vec_id, list_transform(embedding, lambda x: 3.0 * cast(x as double)) as v from embeddings) select vec_id, list_transform(v, lambda x: round(x / sqrt(list_inner_product(v, v)), 6)) as v from t")
def l2_norm(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3.0)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(V.l2_normalize(scaled), lambda x: V.rounded(x)).alias("v"))


@query("""with e as (select label, vec_id, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as pos from embeddings),
m as (select label, pos, avg(cast(x as double)) as x from e group by label, pos) select label, list(round(x, 6) order by pos) as v from m group by label""")
def mean_pool(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return V.mean_by(e, "label", "embedding").select("label", F.transform("embedding", lambda x: V.rounded(x)).alias("v"))


@query(f"with {SIDES_SQL} select s.idx, round(list_inner_product(s.v, t.v), 6) as score from sides s join sides t on s.idx = t.idx and s.side = 'src' and t.side = 'tgt'")
def dot_score(spark, sf_dir):
    t = side(spark, sf_dir, "tgt").withColumnRenamed("embedding", "other")
    return side(spark, sf_dir, "src").join(t, "idx").select("idx", V.rounded(V.dot(F.col("embedding"), F.col("other"))).alias("score"))


_TOP = f"""{SIDES_SQL}, d as (select s.idx, t.idx as tgt_idx, round(list_inner_product(s.v, t.v), 12) as score from sides s join sides t on s.side = 'src' and t.side = 'tgt'),
r as (select idx, tgt_idx, score, row_number() over (partition by idx order by score desc, tgt_idx) as rank, row_number() over (partition by tgt_idx order by score desc, idx) as back from d)"""


@query(f"with {_TOP} select idx, cast(rank as integer) as rank, tgt_idx, round(score, 6) as score from r where rank <= 3")
def cosine_topk(spark, sf_dir):
    return align.top_k(side(spark, sf_dir, "src"), side(spark, sf_dir, "tgt"), 3).select("idx", "rank", "tgt_idx", V.rounded("score").alias("score"))


@query(f"with {_TOP} select idx as src_idx, tgt_idx, round(score, 6) as score from r where rank = 1 and back = 1")
def mutual_nn(spark, sf_dir):
    m = align.mutual_nearest(side(spark, sf_dir, "src"), side(spark, sf_dir, "tgt"))
    return m.select("src_idx", "tgt_idx", V.rounded("score").alias("score"))


@query(f"""with {_TOP} select count(*) as n_pairs, round(avg(case when idx = tgt_idx then 1.0 else 0.0 end), 6) as precision_at_1,
    (select round(avg(score), 6) from d where idx = tgt_idx) as diagonal_mean from r where rank = 1""")
def precision_at_1(spark, sf_dir):
    s, t = side(spark, sf_dir, "src"), side(spark, sf_dir, "tgt")
    best = align.top_k(s, t, 1).agg(F.count("*").alias("n_pairs"), F.round(F.avg((F.col("idx") == F.col("tgt_idx")).cast("double")), 6).alias("precision_at_1"))
    diagonal = s.join(t.withColumnRenamed("embedding", "other"), "idx").agg(V.rounded(F.avg(V.dot(F.col("embedding"), F.col("other")))).alias("diagonal_mean"))
    return _one_row(best, diagonal)


# -- beads ------------------------------------------------------------------------------------

LINES = """case when vec_id % 11 = 0 then '# comment' when vec_id % 5 = 1 then concat('[', vec_id, ', ', vec_id + 1, ']:[]:', {s})
    when vec_id % 5 = 2 then concat('[]:[', vec_id, ']:-', {s}) else concat('[', vec_id, ']:[', vec_id, '--', vec_id + vec_id % 3, ']:', {s}) end"""
_S = {"spark": "format_string('%.2f', cast(vec_id % 100 as double) / 100)", "duckdb": "printf('%.2f', (vec_id % 100) / 100.0)"}
BEADS_SQL = """beads as (select vec_id as bead, case when vec_id % 5 = 1 then [vec_id, vec_id + 1] when vec_id % 5 = 2 then []::bigint[] else [vec_id] end as src_idx,
    case when vec_id % 5 = 1 then []::bigint[] when vec_id % 5 = 2 then [vec_id] else range(vec_id, vec_id + vec_id % 3 + 1) end as tgt_idx,
    case when vec_id % 5 = 2 then -1 else 1 end * (vec_id % 100) / 100.0 as score from embeddings where vec_id % 11 <> 0)"""


def bead_lines(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bead"), F.expr(LINES.format(s=_S["spark"])).alias("line"))


def beads(spark, sf_dir):
    return align.parse_beads(bead_lines(spark, sf_dir))


@query(f"with {BEADS_SQL} select bead, src_idx, tgt_idx, cast(score as double) as score from beads")
def parse_beads(spark, sf_dir):
    return beads(spark, sf_dir)


@query("select vec_id, case vec_id % 4 when 0 then []::bigint[] when 1 then [vec_id] when 2 then range(vec_id, vec_id + vec_id % 5 + 1) else []::bigint[] end as out from embeddings")
def expand_ranges(spark, sf_dir):
    text = F.expr("case vec_id % 4 when 0 then '' when 1 then string(vec_id) when 2 then concat(vec_id, '--', vec_id + vec_id % 5) else concat(vec_id, '--', vec_id - 1) end")
    return table(spark, sf_dir, "embeddings").select("vec_id", align.expand_range(text).alias("out"))


_SENT = "sent as (select doc_id as idx, 1000 + doc_id as original, text from documents where doc_id % 13 <> 0)"
_GATHERED = f"""{BEADS_SQL}, {_SENT}, m as (select bead, unnest(tgt_idx) as idx, unnest(range(1, len(tgt_idx) + 1)) as pos from beads),
g as (select bead, string_agg(text, ' ' order by pos) as t, list(original order by pos) as o from m join sent using (idx) group by bead)"""


@query(f"with {_GATHERED} select beads.bead, coalesce(t, '') as tgt, coalesce(o, []) as tgt_lines from beads left join g on g.bead = beads.bead")
def gather_text(spark, sf_dir):
    s = table(spark, sf_dir, "documents").where("doc_id % 13 <> 0").select(F.col("doc_id").alias("idx"), (F.col("doc_id") + 1000).alias("original"), "text")
    return align.gather(beads(spark, sf_dir), s, "tgt_idx", "tgt").select("bead", "tgt", "tgt_lines")


_TWO = "case when vec_id % 2 = 0 then [vec_id // 2] else [vec_id // 2, vec_id // 2 + 1] end"


@query(f"""with {SIDES_SQL}, b as (select vec_id as bead, [vec_id // 2] as src_idx, {_TWO} as tgt_idx from embeddings),
p as (select bead, 'src' as side, unnest(src_idx) as idx from b union all select bead, 'tgt', unnest(tgt_idx) from b),
x as (select bead, p.side, unnest(v) as x, unnest(range(1, 65)) as pos from p join sides on sides.side = p.side and sides.idx = p.idx),
m as (select bead, side, pos, avg(x) as x from x group by bead, side, pos)
select s.bead, round(sum(s.x * t.x), 6) as score, round(sum(s.x * t.x) / sqrt(sum(s.x * s.x) * sum(t.x * t.x)), 6) as cosine from m s join m t on s.bead = t.bead and s.pos = t.pos and s.side = 'src' and t.side = 'tgt' group by s.bead""")
def bead_scores(spark, sf_dir):
    two = F.expr("case when vec_id % 2 = 0 then array(vec_id div 2) else array(vec_id div 2, vec_id div 2 + 1) end")
    b = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bead"), F.array(F.expr("vec_id div 2")).alias("src_idx"), two.alias("tgt_idx"))
    return align.bead_scores(b, embeddings(spark, sf_dir)).select("bead", V.rounded("score").alias("score"), V.rounded("cosine").alias("cosine"))


@query(f"with {BEADS_SQL} select cast(len(src_idx) as bigint) as n_src, cast(len(tgt_idx) as bigint) as n_tgt, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from beads where len(src_idx) > 0 and len(tgt_idx) > 0 group by len(src_idx), len(tgt_idx)")
def bead_types(spark, sf_dir):
    b = align.two_sided(beads(spark, sf_dir)).groupBy(F.size("src_idx").cast("long").alias("n_src"), F.size("tgt_idx").cast("long").alias("n_tgt")).agg(F.count("*").alias("n"))
    return b.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query(f"with {BEADS_SQL} select bead, cast(score as double) as score from beads where score >= 0.5")
def score_filter(spark, sf_dir):
    return align.above(beads(spark, sf_dir)).select("bead", "score")


@query(f"with {BEADS_SQL} select bead, cast(score as double) as score from beads where score < 0.5")
def low_score_pairs(spark, sf_dir):
    return beads(spark, sf_dir).where(F.col("score") < align.MIN_SCORE).select("bead", "score")


# -- the deliverable --------------------------------------------------------------------------

PAIRS = """select doc_id, case when doc_id % 17 = 0 then ' ' when doc_id % 19 = 0 then null else text end as src,
    concat(' ', text, chr(10), chr(9), ' x') as tgt, cast(doc_id % 100 as double) / 100 as score from documents"""
_FLAT = f"""flat as (select doc_id, score, {{s}} as src, {{t}} as tgt from ({PAIRS})),
judged as (select *, case when src = '' or tgt = '' then 'empty' when length(src) > 2000 or length(tgt) > 2000 then 'long' else 'kept' end as v from flat)""".format(
    **{k: f"regexp_replace(regexp_replace(coalesce({c}, ''), '{WS}+', ' ', 'g'), '^ | $', '', 'g')".replace("{", "{{").replace("}", "}}") for k, c in (("s", "src"), ("t", "tgt"))}
).replace("{{", "{").replace("}}", "}")


def pairs(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("_pair_documents")
    return spark.sql(PAIRS.replace("from documents", "from _pair_documents"))


@query(f"with {_FLAT} select cast(row_number() over (order by doc_id) as bigint) as pair_id, src as han_sentence, tgt as viet_sentence from judged where v = 'kept'")
def export_pairs(spark, sf_dir):
    return export.deliverable(pairs(spark, sf_dir), "doc_id").withColumn("pair_id", F.col("pair_id").cast("long"))


@query(f"with {_FLAT} select count(*) as n_pairs, count(*) filter (v = 'empty') as n_empty, count(*) filter (v = 'long') as n_long, count(*) filter (v = 'kept') as n_kept from judged")
def export_drop_counts(spark, sf_dir):
    return export.drop_counts(pairs(spark, sf_dir))


@query(f"with {TQ.NORMAL_SENTENCES_SQL}, {_FLAT} select (select count(*) from sents) as sentences, count(*) as pairs, round(count(*) / (select count(*) from sents), 6) as yield from judged where v = 'kept'")
def yield_stats(spark, sf_dir):
    s = TQ.han_sentences(TQ.docs(spark, sf_dir)).agg(F.count("*").alias("sentences"))
    p = export.drop_counts(pairs(spark, sf_dir)).select(F.col("n_kept").alias("pairs"))
    return _one_row(s, p).withColumn("yield", F.round(F.col("pairs") / F.col("sentences"), 6))


_SCORED = "select doc_id, cast(doc_id * 7919 % 1000 as double) / 1000 as score from documents"


def scored(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr("cast(doc_id * 7919 % 1000 as double) / 1000 as score"))


@query(f"select count(*) as n_pairs, round(avg(score), 6) as mean, round(median(score), 6) as median, round(stddev_samp(score), 6) as stdev from ({_SCORED})")
def score_summary(spark, sf_dir):
    s = evaluate.score_summary(scored(spark, sf_dir))
    return s.select("n_pairs", *[F.round(c, 6).alias(c) for c in ("mean", "median", "stdev")])


@query(f"select case when score < 0.2 then 0 when score < 0.5 then 1 when score < 0.7 then 2 when score < 0.9 then 3 else 4 end as bin, count(*) as n from ({_SCORED}) group by 1")
def score_histogram(spark, sf_dir):
    return scored(spark, sf_dir).groupBy(evaluate.score_bin(F.col("score")).alias("bin")).agg(F.count("*").alias("n"))


@query(f"""select doc_id, score, stratum from (select *, row_number() over (partition by stratum order by md5(cast(doc_id as varchar)), doc_id) as r from
    (select *, case when score < 0.5 then 'low' when score < 0.7 then 'mid' else 'high' end as stratum from ({_SCORED}))) where r <= case stratum when 'mid' then 200 else 150 end""")
def stratified_sample(spark, sf_dir):
    return evaluate.stratified(scored(spark, sf_dir), "doc_id", {"low": 150, "mid": 200, "high": 150})


_HOLD = "select doc_id, case when cast('0x' || substring(md5('42:' || doc_id), 1, 8) as bigint) % 100 < 20 then 'test' else 'train' end as part from documents"


@query(_HOLD)
def holdout_split(spark, sf_dir):
    return evaluate.holdout(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(f"select count(*) as n_pairs, count(*) < 5000 as skipped, count(*) filter (part = 'test') as n_test from ({_HOLD})")
def holdout_gate(spark, sf_dir):
    h = evaluate.holdout(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return h.agg(F.count("*").alias("n_pairs"), (F.count("*") < 5000).alias("skipped"), F.count_if(F.col("part") == "test").alias("n_test"))


# -- entities ---------------------------------------------------------------------------------

#: A small table of our own from characters to readings.
READINGS = {"紹": "thiệu", "治": "trị", "太": "thái", "保": "bảo", "王": "vương", "安": "an", "南": "nam", "國": "quốc", "皇": "hoàng", "帝": "đế", "大": "đại", "明": "minh"}
_HAN = ["紹治", "太保", "安南", "大明"]
_VIET = ["Thiệu Trị năm", "thái bảo", "Nam", "Minh Mạng"]
_SOUND = [" ".join(READINGS[c] for c in x) for x in _HAN]
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


@query(f"select doc_id, {_LIST(_SOUND)}[doc_id % 4 + 1] || ' x' as out from documents")
def translit(spark, sf_dir):
    name = F.get(F.array(*[F.lit(x) for x in _HAN]), (F.col("doc_id") % 4).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", evaluate.transliterate(F.concat(name, F.lit("x")), READINGS).alias("out"))


_ENTITIES = f"""ent as (select doc_id, doc_id % 4 + 1 as h, [{', '.join(f"'{x}'" for x in _VIET)}][doc_id // 4 % 4 + 1] as viet, doc_id % 5 <> 0 as has from documents),
met as (select doc_id, h, viet, has, has and (contains(lower(viet), {_LIST(_SOUND)}[h]) or contains({_LIST(_SOUND)}[h], lower(viet))) as hit from ent)"""


def entity_rows(spark, sf_dir):
    pick = lambda xs, at: F.get(F.array(*[F.lit(x) for x in xs]), at.cast("int"))
    d = table(spark, sf_dir, "documents")
    h, v = F.col("doc_id") % 4, F.expr("doc_id div 4 % 4")
    han = F.struct(pick(_HAN, h).alias("text"), evaluate.transliterate(pick(_HAN, h), READINGS).alias("sound"))
    some = F.col("doc_id") % 5 != 0
    return d.select("doc_id", F.when(some, F.array(han)).otherwise(F.array().cast("array<struct<text:string,sound:string>>")).alias("han"), F.when(some, F.array(pick(_VIET, v))).otherwise(F.array().cast("array<string>")).alias("viet"))


@query(f"with {_ENTITIES} select doc_id, {_LIST(_HAN)}[h] as han, viet from met where hit")
def entity_bridge(spark, sf_dir):
    m = entity_rows(spark, sf_dir).select("doc_id", F.explode(evaluate.entity_matches(F.col("han"), F.col("viet"))).alias("m"))
    return m.select("doc_id", "m.han", "m.viet")


@query(f"with {_ENTITIES} select count(*) as pairs, count(*) filter (has) as with_entity, count(*) filter (hit) as matched, round(count(*) filter (hit) / count(*) filter (has), 6) as coverage, round(count(*) filter (hit) / count(*), 6) as of_all from met")
def bridge_coverage(spark, sf_dir):
    e = entity_rows(spark, sf_dir).select((F.size("han") + F.size("viet") > 0).alias("has"), (F.size(evaluate.entity_matches(F.col("han"), F.col("viet"))) > 0).alias("hit"))
    c = e.agg(F.count("*").alias("pairs"), F.count_if("has").alias("with_entity"), F.count_if("hit").alias("matched"))
    return c.withColumns({"coverage": F.round(F.col("matched") / F.col("with_entity"), 6), "of_all": F.round(F.col("matched") / F.col("pairs"), 6)})


@query(f"""with {BEADS_SQL}, e as (select vec_id as idx, unnest(case vec_id % 4 when 0 then ['a' || label] when 1 then ['b' || label, 'c'] else []::varchar[] end) as entity from embeddings),
m as (select bead, unnest(tgt_idx) as idx from beads), g as (select bead, list_sort(list(distinct entity)) as entities from m join e using (idx) group by bead)
select beads.bead, coalesce(entities, []) as entities from beads left join g on g.bead = beads.bead where len(src_idx) > 0 and len(tgt_idx) > 0""")
def pair_entity_join(spark, sf_dir):
    """Entities by sentence, collected for each pair."""
    some = "explode(case vec_id % 4 when 0 then array(concat('a', label)) when 1 then array(concat('b', label), 'c') else array() end) as entity"
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("idx"), F.expr(some))
    return align.pair_entities(align.two_sided(beads(spark, sf_dir)), e, "tgt_idx", "entities").select("bead", "entities")


# -- metrics ----------------------------------------------------------------------------------

_RATED = """select 'quality' as criterion, doc_id as unit, 1 as rater, 1 + doc_id % 5 as value from labels
    union all select 'quality', doc_id, 2, 1 + (doc_id + case when doc_id % 4 = 0 then 1 else 0 end) % 5 from labels
    union all select 'quality', doc_id, 3, 1 + doc_id % 5 from labels where doc_id % 2 = 0
    union all select 'alone', doc_id, 1, 1 + doc_id % 3 from labels"""


@query(f"""with r as ({_RATED}), u as (select *, count(*) over (partition by criterion, unit) as m from r), p as (select * from u where m > 1),
o as (select a.criterion, a.value as c, b.value as k, sum(1.0 / (a.m - 1)) as o from p a join p b on a.criterion = b.criterion and a.unit = b.unit and a.rater <> b.rater group by 1, 2, 3),
n as (select criterion, value, cast(count(*) as double) as n from p group by 1, 2),
d as (select x.criterion, x.value as c, y.value as k, x.n * y.n as nn, pow((select sum(z.n) from n z where z.criterion = x.criterion and z.value between least(x.value, y.value) and greatest(x.value, y.value)) - (x.n + y.n) / 2, 2) as d from n x join n y on x.criterion = y.criterion),
a as (select d.criterion, 1 - ((select sum(n) from n where n.criterion = d.criterion) - 1) * sum(coalesce(o.o, 0) * d.d) / sum(d.nn * d.d) as alpha from d left join o on o.criterion = d.criterion and o.c = d.c and o.k = d.k group by d.criterion)
select c.criterion, round(a.alpha, 6) as alpha from (select distinct criterion from r) c left join a on a.criterion = c.criterion""")
def krippendorff(spark, sf_dir):
    table(spark, sf_dir, "labels").createOrReplaceTempView("_rated_labels")
    ratings = spark.sql(_RATED.replace("from labels", "from _rated_labels"))
    return evaluate.krippendorff_ordinal(ratings).select("criterion", V.rounded("alpha").alias("alpha"))


def _hyp(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("text").alias("ref"), F.replace("text", F.lit(" the "), F.lit(" a ")).alias("hyp"))


_HYP = "h as (select doc_id, text as ref, replace(text, ' the ', ' a ') as hyp from documents)"


def _grams(items: str, orders: int) -> str:
    return f"""t as (select doc_id, {items.format('ref')} as r, {items.format('hyp')} as h from h), o as (select unnest(range(1, {orders + 1})) as n),
g as (select doc_id, n, 'h' as side, array_to_string(h[i : i + n - 1], chr(31)) as gram from (select doc_id, n, h, unnest(range(1, len(h) - n + 2)) as i from t, o)
    union all select doc_id, n, 'r', array_to_string(r[i : i + n - 1], chr(31)) from (select doc_id, n, r, unnest(range(1, len(r) - n + 2)) as i from t, o)),
c as (select doc_id, n, gram, count(*) filter (side = 'h') as h, count(*) filter (side = 'r') as r from g group by 1, 2, 3),
m as (select n, sum(least(h, r)) as matched, sum(h) as hyp, sum(r) as ref from c group by n)"""


@query(f"""with {_HYP}, {_grams("list_filter(string_split(regexp_replace({}, '[ \\n]+', ' ', 'g'), ' '), lambda x: x <> '')", 4)}
select round(100 * exp(sum(ln(matched / hyp)) / 4) * (select case when c >= r then 1.0 else exp(1 - r / c) end from (select hyp as c, ref as r from m where n = 1)), 6) as bleu from m""")
def bleu(spark, sf_dir):
    words = lambda c: F.filter(F.split(F.regexp_replace(c, "[ \n]+", " "), " "), lambda x: x != "")
    return evaluate.bleu(_hyp(spark, sf_dir), words(F.col("hyp")), words(F.col("ref"))).select(F.round("bleu", 6).alias("bleu"))


@query()
def chrf(spark, sf_dir):
    """Rows only: SQL takes ten minutes over the whole texts of a thousand documents.  Tested against counted n-grams."""
    return evaluate.chrf(_hyp(spark, sf_dir), F.col("hyp"), F.col("ref")).select(F.round("chrf", 6).alias("chrf"))


_ASCII = "regexp_replace(line, '[^ -~]', '', 'g')"


@query(f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as page from documents),
g as (select doc_id, page, {_ASCII} as g from l), p as (select doc_id, page, replace(g, 'th', 't') as h from g where page % 9 <> 8)
select cast(sum(levenshtein(h, g)) as bigint) as errors, cast(sum(length(g)) as bigint) as chars, round(sum(levenshtein(h, g)) / sum(length(g)), 6) as cer from p join g using (doc_id, page)""")
def cer(spark, sf_dir):
    """Every line of every document is a page of its own; recognised pages meet gold ones by name."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page", "line"))
    gold = lines.select("doc_id", "page", F.regexp_replace("line", "[^ -~]", "").alias("text"))
    pages = gold.where("page % 9 <> 8").withColumn("text", F.replace("text", F.lit("th"), F.lit("t")))
    return evaluate.cer(pages, gold, ["doc_id", "page"]).withColumn("cer", F.round("cer", 6))


_LEX = "lex as (select p_type as word, count(*) as n from (select lower(split_part(p_type, ' ', 1)) as p_type from part union all select lower(split_part(p_name, ' ', 1)) from part) where p_type <> '' group by 1)"


@query(f"""with {_LEX}, w as (select distinct concat(substring(word, 1, 2), substring(word, 4), 'e') as word from lex),
d as (select w.word, lex.word as fixed, lex.n, levenshtein(w.word, lex.word) as d from w join lex on levenshtein(w.word, lex.word) <= 2)
select word, fixed from (select *, row_number() over (partition by word order by d, n desc, fixed) as r from d) where r = 1""")
def spell_fix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    first = lambda c: F.lower(F.split_part(F.col(c), F.lit(" "), F.lit(1)))
    lex = p.select(first("p_type").alias("word")).unionByName(p.select(first("p_name").alias("word"))).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    words = lex.select(F.concat(F.substring("word", 1, 2), F.expr("substring(word, 4)"), F.lit("e")).alias("word")).distinct()
    return evaluate.spell_fix(words, lex)


@query()
def model_scores(spark, sf_dir):
    """Rows only: a mean of agreements; tested against a direct formula."""
    table(spark, sf_dir, "labels").createOrReplaceTempView("_rated_labels")
    rated = spark.sql(_RATED.replace("from labels", "from _rated_labels"))
    models = F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("model")
    moved = rated.select("*", models).withColumn("value", F.expr("if(model = 'm2' and rater = 2, 6 - value, value)"))
    return evaluate.model_scores(moved).withColumn("mean_alpha", F.round("mean_alpha", 6))


@query(f"""select concat('| metric | value |', chr(10), '|-|-|', chr(10), '| n_pairs | ', count(*), ' |', chr(10), '| kept | ', count(*) filter (score >= 0.5), ' |', chr(10), '| none | – |') as report from ({_SCORED})""")
def report_markdown(spark, sf_dir):
    s = scored(spark, sf_dir).agg(F.count("*").alias("n_pairs"), F.count_if(F.col("score") >= 0.5).alias("kept"), F.lit(None).cast("long").alias("none"))
    return evaluate.markdown_report(s)


@query(f"""with k as ({_DEDUP.replace("group by doc_id % 2, t", "and doc_id % 2 = 0 group by doc_id % 2, t")}) select cast(row_number() over (order by idx) - 1 as bigint) as line, idx, text from k""")
def aligner_input(spark, sf_dir):
    return align.aligner_input(table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("idx"), "text"))


@query("select doc_id as idx from documents where doc_id % 10 = 3 and length(text) > 0 or doc_id % 10 = 7")
def stale_embeddings(spark, sf_dir):
    """Sentences that changed after they were embedded, or were not embedded."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), "text")
    vectors = d.where("idx % 10 <> 7").select("idx", align.text_hash(F.expr("if(idx % 10 = 3, '', text)")).alias("text_hash"))
    return align.stale(d, vectors).select("idx")


@query(f"""select concat('{{"n_pairs":', count(*), ',"kept":', count(*) filter (score >= 0.5), ',"rounded_mean":', cast(round(avg(score) * 1000) as bigint), '}}') as report from ({_SCORED})""")
def report_json(spark, sf_dir):
    s = scored(spark, sf_dir).agg(F.count("*").alias("n_pairs"), F.count_if(F.col("score") >= 0.5).alias("kept"), F.round(F.avg("score") * 1000).cast("long").alias("rounded_mean"))
    return s.select(F.to_json(F.struct("n_pairs", "kept", "rounded_mean")).alias("report"))


# -- alignment --------------------------------------------------------------------------------


def _segments(spark, sf_dir):
    """Sentence vectors in segments of forty rows a side; each target is its source, a little moved."""
    e = table(spark, sf_dir, "embeddings")
    base = e.select(F.expr("vec_id div 40").alias("segment"), F.col("vec_id").alias("idx"), "embedding", F.lit(1.0).alias("length"))
    src = base.withColumn("side", F.lit("src"))
    return src.unionByName(base.where("idx % 7 <> 0").withColumn("side", F.lit("tgt")))


@query()
def align_monotone(spark, sf_dir):
    """Rows only: a dynamic programme."""
    return align.align(_segments(spark, sf_dir)).withColumn("score", V.rounded("score"))


@query()
def align_twopass(spark, sf_dir):
    """Rows only: a dynamic programme in a band."""
    return align.align(_segments(spark, sf_dir), passes=2).withColumn("score", V.rounded("score"))


@query()
def hash_embed(spark, sf_dir):
    """Rows only: the offline stand-in of a sentence embedder."""
    from .. import plugins

    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", plugins.hash_embedder(64)(F.col("text")).alias("embedding"))
