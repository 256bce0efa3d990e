"""Queries over cleaning, names and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ids, pages, split
from . import fixtures as X
from .registry import query, table

WS, END = T.RE2_WS, T.RE2_LINE_END


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _parts(x: str) -> str:
    """Stripped non-empty parts of an SQL list."""
    return f"list_filter(list_transform({x}, lambda s: {_strip('s')}), lambda s: s <> '')"


def _paragraph_lines(x: str) -> str:
    lines = _parts(f"string_split_regex(p, '{END}')")
    kept = f"list_filter(list_transform(string_split_regex({x}, '\\n{{2,}}'), lambda p: array_to_string({lines}, chr(10))), lambda p: p <> '')"
    return f"concat({_strip(f'array_to_string({kept}, chr(10) || chr(10))')}, chr(10))"


BRACKETS_SQL = "regexp_replace(@@, '【[^】]*】', '', 'g')"
HEADERS_SQL = "regexp_replace(@@, '(?m)^(?:姊妹计划\\s*[:：].*|数据项|#.*|\\s*---+\\s*)$', '', 'g')"
_FW, _HW = T.FULL.replace("'", "''"), T.HALF.replace("'", "''")
FOLD_SQL = f"translate(@@, '{_FW}', '{_HW}')"
COLLAPSE_SQL = "regexp_replace(@@, '\\n{3,}', chr(10) || chr(10), 'g')"


def _normalized(x: str) -> str:
    for step in (BRACKETS_SQL, HEADERS_SQL, FOLD_SQL, COLLAPSE_SQL):
        x = step.replace('@@', x)
    return _paragraph_lines(x)


TERM_SQL = _parts(f"string_split(regexp_replace(@@, '([{T.TERMINATORS}])', '\\1' || chr(1), 'g'), chr(1))")
NORMAL_SENTENCES_SQL = f"""paras as (select doc_id, lang, unnest(ps) as p, unnest(range(1, len(ps) + 1)) as para from
    (select doc_id, lang, {_parts(f"string_split_regex(n, '{chr(92)}n{{2,}}')")} as ps from (select doc_id, lang, {_normalized(X.MARKED)} as n from documents))),
sents as (select doc_id, lang, para, unnest(ss) as s, unnest(range(1, len(ss) + 1)) as pos from (select doc_id, lang, para, {TERM_SQL.replace('@@', 'p')} as ss from paras))"""


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def han_sentences(d):
    """(doc_id, lang, para, pos, s): cleaned, cut into paragraphs and sentences."""
    clean = d.select("doc_id", "lang", T.normalize(F.expr(X.MARKED)).alias("n"))
    paras = clean.select("doc_id", "lang", F.posexplode(split.paragraphs(F.col("n"))).alias("para", "p"))
    return paras.select("doc_id", "lang", (F.col("para") + 1).cast("long").alias("para"), F.posexplode(split.split_terminators(F.col("p"))).alias("pos", "s")).withColumn("pos", (F.col("pos") + 1).cast("long"))


def _out(d, column):
    return d.select("doc_id", column.alias("out"))


@query("select doc_id, regexp_replace(concat(text, chr(13), chr(10), 'x', chr(13)), '\\r\\n?', chr(10), 'g') as out, cast(length(text) as bigint) as n_chars from documents")
def scan_documents(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.unix_newlines(F.expr("concat(text, chr(13), chr(10), 'x', chr(13))")).alias("out"), F.length("text").cast("long").alias("n_chars"))


@query(f"select doc_id, {BRACKETS_SQL.replace('@@', X.MARKED)} as out from documents")
def strip_brackets(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.strip_brackets(F.expr(X.MARKED)))


HEADED = "concat('姊妹计划 : 数据项', chr(10), text, chr(10), '#top', chr(10), ' --- ', chr(10), '数据项', chr(10), 'x#y')"


@query(f"select doc_id, {HEADERS_SQL.replace('@@', HEADED)} as out from documents")
def strip_headers(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.strip_headers(F.expr(HEADED)))


@query(f"select doc_id, {FOLD_SQL.replace('@@', X.WIDE)} as out from documents")
def fullwidth_fold(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.fold_fullwidth(F.expr(X.WIDE)))


@query(f"select doc_id, {_normalized(X.MARKED)} as out from documents")
def normalize_text(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.normalize(F.expr(X.MARKED)))


@query(f"select doc_id, {_strip(f'''regexp_replace({X.SPACED}, '{WS}+', ' ', 'g')''')} as out from documents")
def flatten_ws(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.flatten_ws(F.expr(X.SPACED)))


@query("select doc_id, substring(text, 101, 250) as out from documents")
def char_window(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.char_window(F.col("text"), 100, 250))


_UNTAGGED = f"regexp_replace(regexp_replace({X.GROUNDED}, '(?s)<\\|det\\|>.*?<\\|/det\\|>', '', 'g'), '<\\|/?ref\\|>', '', 'g')"


@query(f"select doc_id, {_strip(COLLAPSE_SQL.replace('@@', f'''regexp_replace({_UNTAGGED}, '(?m)[ \\t]+$', '', 'g')'''))} as out from documents")
def clean_grounding(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.clean_grounding(F.expr(X.GROUNDED)))


@query("select doc_id, translate(translate(text, 'kz', 'ℓñ'), 'ℓñ', 'ln') as out from documents")
def rule_fix(spark, sf_dir):
    return _out(docs(spark, sf_dir), T.rule_fix(F.translate("text", "kz", "ℓñ")))


@query(f"""with n as (select doc_id, doc_id % 4 as k, {X.VOLUME} as v, {X.PAGE['duckdb']} as p from documents)
select doc_id, case k when 0 then 'tap' || (4 + doc_id % 3) when 1 then 'tap' || (4 + (doc_id + 1) % 3) else 'other_book_' || p end as volume,
    concat(v, '_', printf('%04d', p)) as image, concat(v, '_page') as image_key, p as image_page,
    case when k = 3 then 'a_b' else v end as text_volume, case when k = 3 then -1 else p end as text_page,
    case when k < 2 then 'tap' || (4 + doc_id % 3) end as pdf_volume, p as layout_page from n""")
def parse_names(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.expr("doc_id % 4 as k"), F.expr(f"{X.VOLUME} as v"), F.expr(f"{X.PAGE['spark']} as p"))
    d = d.withColumn("n", F.expr("4 + doc_id % 3").cast("string"))
    stem = F.when(F.col("k") == 0, F.concat(F.lit("Book TẬP "), "n")).when(F.col("k") == 1, F.concat(F.lit("book tap "), "n", F.lit(" tập "), F.expr("4 + (doc_id + 1) % 3"))).otherwise(F.concat(F.lit("other book "), F.col("p")))
    pdf = F.when(F.col("k") == 0, F.concat(F.lit("Book TẬP "), "n")).when(F.col("k") == 1, F.concat(F.lit("tập"), "n")).otherwise(F.lit("other"))
    key, page = T.page_of_image(F.format_string("%s_page_%04d", "v", "p"))
    volume, text_page = T.page_of_text(F.when(F.col("k") == 3, F.lit("a_b")).otherwise(F.format_string("%s_page_%04d", "v", "p")))
    return d.select(
        "doc_id", T.volume_key(stem).alias("volume"), F.format_string("%s_%04d", "v", "p").alias("image"), key.alias("image_key"), page.alias("image_page"),
        volume.alias("text_volume"), text_page.alias("text_page"), T.volume_of_pdf(pdf).alias("pdf_volume"), T.page_of_layout(F.format_string("%s_%d_res.json", "v", "p")).alias("layout_page"),
    )


@query("select doc_id, concat('data:image/', case when doc_id % 2 = 0 then 'jpeg' else 'png' end, ';base64,', base64(encode(text))) as url from documents")
def b64_url(spark, sf_dir):
    name = F.when(F.expr("doc_id % 2 = 0"), F.lit("a.JPG")).otherwise(F.lit("a.tiff"))
    return docs(spark, sf_dir).select("doc_id", T.data_url(F.encode("text", "utf-8"), name).alias("url"))


def _exploded(sql_list: str, source: str = "documents") -> str:
    return f"select doc_id, cast(unnest(range(0, len(l))) as bigint) as pos, unnest(l) as out from (select doc_id, {sql_list} as l from {source})"


def _explode(d, column):
    return d.select("doc_id", F.posexplode(column).alias("pos", "out")).withColumn("pos", F.col("pos").cast("long"))


@query(_exploded(_parts(f"string_split_regex({X.PARAGRAPHS}, '\\n{{2,}}')")))
def paragraphs(spark, sf_dir):
    return _explode(docs(spark, sf_dir), split.paragraphs(F.expr(X.PARAGRAPHS)))


@query(_exploded(TERM_SQL.replace('@@', X.CLASSICAL)))
def split_terminators(spark, sf_dir):
    return _explode(docs(spark, sf_dir), split.split_terminators(F.expr(X.CLASSICAL)))


BLOCK = "repeat(concat(translate(text, '.,!?;', ''), chr(10)), 3)"


@query(_exploded(f"""list_filter(list_append(r.out, r.buf), lambda s: s <> '')""", f"""(select doc_id, list_reduce({_parts(f"string_split({BLOCK}, chr(10))")},
    lambda a, x: case when length(a.buf) + length(x) >= 200 then {{'out': list_append(a.out, a.buf || x), 'buf': ''}} else {{'out': a.out, 'buf': a.buf || x}} end,
    {{'out': []::varchar[], 'buf': ''}}) as r from (select doc_id, text from documents))"""))
def greedy_merge(spark, sf_dir):
    return _explode(docs(spark, sf_dir), split.greedy_merge(F.expr(BLOCK)))


def _chunks(x: str) -> str:
    return f"""(select doc_id, list_reduce(string_split({x}, chr(10) || chr(10)),
    lambda a, p: case when a.cur <> '' and length(a.cur) + length(p) + 2 > 500 then {{'out': list_append(a.out, a.cur), 'cur': p}}
        when a.cur = '' then {{'out': a.out, 'cur': p}} else {{'out': a.out, 'cur': a.cur || chr(10) || chr(10) || p}} end,
    {{'out': []::varchar[], 'cur': ''}}) as r from documents)"""


@query(_exploded("list_filter(list_append(r.out, r.cur), lambda s: s <> '')", _chunks(X.PARAGRAPHS)))
def chunk_text(spark, sf_dir):
    return _explode(docs(spark, sf_dir), split.chunk_text(F.expr(X.PARAGRAPHS)))


@query(f"select doc_id, md5({X.PARAGRAPHS}) as whole, cast(len(list_filter(list_append(r.out, r.cur), lambda s: s <> '')) as bigint) as n from {_chunks(X.PARAGRAPHS)} join documents using (doc_id)")
def chunk_roundtrip(spark, sf_dir):
    """Chunks, each through the identity corrector, joined again."""
    d = docs(spark, sf_dir).select("doc_id", split.chunk_text(F.expr(X.PARAGRAPHS)).alias("c"))
    return d.select("doc_id", F.md5(F.array_join("c", "\n\n")).alias("whole"), F.size("c").cast("long").alias("n"))


_VIET = f"""list_filter(list_transform(flatten(list_transform(string_split(regexp_replace({_strip(X.MODERN)}, '([。；！？]){WS}+', '\\1' || chr(1), 'g'), chr(1)),
    lambda c: string_split(regexp_replace(c, '([.!?:\\n]){WS}+', '\\1' || chr(1), 'g'), chr(1)))), lambda s: {_strip('s')}), lambda s: length(s) >= 2)"""


@query(_exploded(_VIET))
def split_viet(spark, sf_dir):
    return _explode(docs(spark, sf_dir), split.split_viet(F.expr(X.MODERN)))


@query()
def split_classical(spark, sf_dir):
    """Rows only: nested annotations are not regular.  Tested against a scanner."""
    nested = F.expr(f"case when doc_id % 3 = 0 then replace({X.ANNOTATED}, ' and ', ' 〈a〈b。〉c〉 ') else {X.ANNOTATED} end")
    return _explode(docs(spark, sf_dir), split.split_classical(nested))


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as pos from documents)
select doc_id, cast(pos as bigint) as pos, cast(sum(case when length(line) < 60 then 1 else 0 end) over (partition by doc_id order by pos) as bigint) as segment from l""")
def chapter_segments(spark, sf_dir):
    """Short lines are headings; a running sum of heading flags is the segment."""
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return split.chapter_segments(lines, "doc_id", "pos", "line").select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "segment")


@query(f"with {NORMAL_SENTENCES_SQL} select doc_id, cast(para as bigint) as para, cast(pos as bigint) as pos, cast(row_number() over (order by doc_id, para, pos) - 1 as bigint) as idx from sents")
def sentence_index(spark, sf_dir):
    s = han_sentences(docs(spark, sf_dir)).select("doc_id", "para", "pos")
    return ids.dense_index(s, "doc_id", ["para", "pos"]).select("doc_id", "para", "pos", F.col("idx").cast("long").alias("idx"))


@query(f"with {NORMAL_SENTENCES_SQL} select lang, count(*) as sentences, count(distinct (doc_id, para)) as paragraphs, round(avg(length(s)), 6) as avg_chars from sents group by lang")
def split_stats(spark, sf_dir):
    s = han_sentences(docs(spark, sf_dir))
    return s.groupBy("lang").agg(F.count("*").alias("sentences"), F.count_if((F.col("pos") == 1)).alias("paragraphs"), F.round(F.avg(F.length("s")), 6).alias("avg_chars"))


@query(f"select doc_id, cast(length(m) as bigint) as raw_chars, cast(length(c) as bigint) as clean_chars, round(length(c) / length(m), 6) as ratio from (select doc_id, {X.MARKED} as m, {_normalized(X.MARKED)} as c from documents)")
def clean_ratio(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.length(F.expr(X.MARKED)).cast("long").alias("raw_chars"), F.length(T.normalize(F.expr(X.MARKED))).cast("long").alias("clean_chars"))
    return d.withColumn("ratio", F.round(F.col("clean_chars") / F.col("raw_chars"), 6))


@query(f"with {NORMAL_SENTENCES_SQL} select lang, cast(max(length(s)) as bigint) as longest, median(length(s)) as middle, cast(count(*) filter (length(s) > 200) as bigint) as over_200 from sents group by lang")
def length_profile(spark, sf_dir):
    s = han_sentences(docs(spark, sf_dir)).select("lang", F.length("s").alias("n"))
    return s.groupBy("lang").agg(F.max("n").cast("long").alias("longest"), F.expr("percentile(n, 0.5)").alias("middle"), F.count_if(F.col("n") > 200).alias("over_200"))


@query("select doc_id, cast(length(text) as bigint) as n from documents where length(text) > 1500")
def overlong(spark, sf_dir):
    return docs(spark, sf_dir).where(F.length("text") > 1500).select("doc_id", F.length("text").cast("long").alias("n"))


_PAGES = f"select doc_id, {X.VOLUME} as volume, {X.PAGE['duckdb']} as page, case when doc_id % 7 = 0 then '' else concat(text, chr(10)) end as text from documents"


def page_rows(d):
    return d.select("doc_id", F.expr(f"{X.VOLUME} as volume"), F.expr(f"{X.PAGE['spark']} as page"), F.expr("case when doc_id % 7 = 0 then '' else concat(text, chr(10)) end as text"))


@query(f"select volume, concat(string_agg(rtrim(text, chr(10)), chr(10) || chr(10) order by page, text), chr(10)) as text from ({_PAGES}) group by volume")
def combine_pages(spark, sf_dir):
    return pages.combine(page_rows(docs(spark, sf_dir)))


@query(f"select volume, concat(string_agg({_strip('text')}, chr(10) order by page, text), chr(10)) as text from ({_PAGES}) where {_strip('text')} <> '' group by volume")
def combine_pages_layout(spark, sf_dir):
    return pages.combine(page_rows(docs(spark, sf_dir)), "\n", keep_empty=False)


@query(f"""with v as (select volume, concat(string_agg(rtrim(text, chr(10)), chr(10) || chr(10) order by page, text), chr(10)) as text from ({_PAGES}) group by volume)
select concat(string_agg(concat('===== ', volume, ' =====', chr(10), rtrim(text, chr(10))), chr(10) || chr(10) order by volume), chr(10)) as text from v""")
def raw_concat(spark, sf_dir):
    return pages.raw_concat(pages.combine(page_rows(docs(spark, sf_dir))))


_LABELS = ["text", "doc_title", "paragraph_title", "abstract", "aside_text", "footnote", "reference_content", "content", "vertical_text", "image", "table", "header"]
_LABEL_SQL = "[" + ", ".join(f"'{x}'" for x in _LABELS) + "]"


@query(f"""with b as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as i from documents),
k as (select doc_id, {_strip('line')} as c, case when i % 5 = 0 then 1 else 0 end as late, case when i % 5 = 0 then i else -i end as key from b where i % 12 < 9)
select d.doc_id, coalesce(string_agg(c, chr(10) || chr(10) order by late, key), '') as out from documents d left join (select * from k where c <> '') k on k.doc_id = d.doc_id group by d.doc_id""")
def layout_render(spark, sf_dir):
    labels = F.array(*[F.lit(x) for x in _LABELS])
    blocks = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        F.get(labels, i % 12).alias("block_label"), x.alias("block_content"), F.when(i % 5 != 0, -i).alias("block_order"), i.alias("block_id")))
    return docs(spark, sf_dir).select("doc_id", pages.render_blocks(blocks).alias("out"))


@query(f"select doc_id, volume, page from ({_PAGES}) where page % 4 <> 0")
def resume_anti_join(spark, sf_dir):
    p = page_rows(docs(spark, sf_dir))
    return pages.pending(p, p.where("page % 4 = 0")).select("doc_id", "volume", "page")


@query(f"select volume, page, case when page % 4 = 0 then concat('fixed ', text) else text end as text from ({_PAGES})")
def coalesce_source(spark, sf_dir):
    """Corrected pages where there are any, raw ones elsewhere."""
    p = page_rows(docs(spark, sf_dir)).select("volume", "page", "text")
    return pages.prefer(p.where("page % 4 = 0").withColumn("text", F.concat(F.lit("fixed "), "text")), p, ["volume", "page"], whole=False)


@query(f"select volume, page, cast((row_number() over (order by volume, page) - 1) % 5 as bigint) as shard from ({_PAGES})")
def round_robin_shard(spark, sf_dir):
    return pages.shard(page_rows(docs(spark, sf_dir)).select("volume", "page"), 5, ["volume", "page"])


@query(f"select volume, page from ({_PAGES}) where page % 4 <> 0 order by volume, page limit 20")
def limit_pending(spark, sf_dir):
    p = page_rows(docs(spark, sf_dir)).select("volume", "page")
    return pages.pending(p, p.where("page % 4 = 0")).orderBy("volume", "page").limit(20)


@query(f"select volume, page from ({_PAGES}) where volume = 'tap4' and page between 11 and 30")
def page_range(spark, sf_dir):
    offset, n = 10, 20
    return page_rows(docs(spark, sf_dir)).where((F.col("volume") == "tap4") & F.col("page").between(offset + 1, offset + n)).select("volume", "page")
