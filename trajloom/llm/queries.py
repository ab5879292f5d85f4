"""The registered queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversations import damaged, repaired
from .decontamination import contamination
from .embedding_dedup import near_vectors
from .hard_negatives import mine
from .html_text import extracted
from .language import identify
from .near_dedup import near_duplicates
from .packing import pack
from .pii import find
from .quality import scored
from .rules import STOP_WORDS, judged
from .sharding import shards
from .token_files import read, write

#: The id behind each document.
END = 2
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
    with d as (select doc_id, {_WORDS} w from documents),
    b as (select item_id, {_WORDS} w from benchmark),
    win as (
        select distinct item_id, unnest([w[i : i + 12] for i in range(1, greatest(len(w) - 12, 1) + 1)]) g from b where len(w) > 0),
    sizes as (select distinct len(g) n from win),
    place as (
        select doc_id, n, unnest(range(1, len(w) - n + 2)) p, w from d, sizes where len(w) >= n),
    occ as (select doc_id, p, n, item_id from place join win on win.g = place.w[p : p + n - 1]),
    hit as (select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + n)) q from occ) group by 1),
    found as (
        select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) items
        from (select distinct doc_id, cast(item_id as varchar) item_id from occ) group by 1)
    select d.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
           sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
    from d left join hit using (doc_id) left join found using (doc_id)
    """
)
def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document against every benchmark window."""
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("spans", "items")


@query(
    f"""
    with recursive w as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') w from documents),
    s as (
        select distinct doc_id, unnest(case when len(w) < 2 then [array_to_string(w, ' ')]
               else [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] end) g from w where len(w) > 0),
    n as (select doc_id, count(*) n from s group by 1),
    met as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b using (g) group by 1, 2),
    link as (
        select x, y from met join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
    reach as (select doc_id x, doc_id y from documents union select r.x, l.y from reach r join link l on l.x = r.y),
    low as (select x doc_id, min(y) component_id from reach group by 1)
    select doc_id, coalesce(n, 0)::bigint n_shingles, component_id, doc_id = component_id kept
    from documents join low using (doc_id) left join n using (doc_id)
    """
)
def op2_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents that share four fifths of their word pairs."""
    return near_duplicates(table(spark, sf, "documents"), width=2)


@query()
def op3_html(spark: SparkSession, sf: str) -> DataFrame:
    """The visible text of every page."""
    return extracted(table(spark, sf, "pages"))


@query()
def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written to token files and read back."""
    return read(write(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), END))


@query()
def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in sequences of 1024 ids."""
    return pack(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), END)


@query()
def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in one of 24 shards."""
    return shards(table(spark, sf, "documents"))


@query()
def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document."""
    return find(table(spark, sf, "documents"))


@query(
    """
    with recursive v as (
        select vec_id, cast(embedding as double[]) e from embeddings
        where list_count(embedding) = len(embedding) and list_dot_product(cast(embedding as double[]), cast(embedding as double[])) > 0),
    link as (
        select a.vec_id x, b.vec_id y from v a join v b on a.vec_id <> b.vec_id
        where list_cosine_similarity(a.e, b.e) >= 0.9),
    reach as (select vec_id x, vec_id y from embeddings union select r.x, l.y from reach r join link l on l.x = r.y),
    low as (select x vec_id, min(y) component_id from reach group by 1),
    n as (select x vec_id, count(*) n from link group by 1)
    select vec_id, coalesce(n, 0)::bigint n_links, component_id, vec_id = component_id kept
    from embeddings join low using (vec_id) left join n using (vec_id)
    """
)
def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors against all, at a cosine of 0.9."""
    return near_vectors(table(spark, sf, "embeddings"))


@query()
def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf, "documents"))


@query()
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality of every document."""
    return scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    f"""
    with t as (
        select doc_id, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: translate(x, {_BLANKS}, '') <> '') l
        from documents),
    place as (select doc_id, w, unnest(range(1, len(w) - 1)) i from t where len(w) > 2),
    gram as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from place),
    twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) n from gram) where n > 1),
    again as (select doc_id, count(distinct k) n from (select doc_id, unnest([i, i + 1, i + 2]) k from twice) group by 1),
    c as (
        select doc_id, len(w)::bigint n_words, length(translate(text, {_BLANKS}, ''))::bigint word_chars,
               (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint n_symbols,
               (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(n, 0)::bigint n_repeat_words, len(l) n_lines,
               len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:?()"''', 'abcdefghijklmnopqrstuvwxyz') in ({_STOPS}))) stops,
               len(list_filter(w, lambda x: translate(x, '0123456789!?.,;:-/()[]{{}}=+_~^''"#*$%&|<>', '') <> '')) lettered,
               len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) bullets,
               len(list_filter(l, lambda x: regexp_matches(rtrim(x), '(\\.\\.\\.|…)$'))) cut
        from t left join again using (doc_id))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
           n_words >= 50 and 100 * n_repeat_words <= 50 * n_words
           and word_chars / n_words between 2 and 12 and n_symbols / n_words <= 0.1 and stops / n_words >= 0.05
           and lettered / n_words >= 0.7 and n_dup_lines / n_lines <= 0.4 and bullets / n_lines <= 0.9 and cut / n_lines <= 0.3 kept
    from c
    """
)
def op13_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every document against the table of quality rules."""
    out = judged(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(
    """
    with v as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
               list_transform(embedding, lambda x: floor(256 * x::double)) e
        from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
        select a.vec_id a, r.vec_id r, a.l = r.l same, list_dot_product(a.e, r.e)::bigint s
        from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
    p as (select a, r p, s from s where same qualify row_number() over (partition by a order by s desc, r) <= 5),
    n as (
        select p.a, p, r, p.s ps, s.s ns, row_number() over (partition by p.a, p order by s.s desc, r) k
        from p join s on s.a = p.a and not same and 80 * p.s <= 100 * s.s and s.s <= p.s)
    select a anchor_id, p positive_id, k::int rank, r negative_id, ps positive_score, ns negative_score from n where k <= 5
    """
)
def op12_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    v = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(v.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def _then(value: str, cost: int | str, letter: str) -> str:
    """SQL of a prefix (nine digits of cost, then letters) with one more edit."""
    return f"(printf('%09d', substr({value}, 1, 9)::int + {cost}) || substr({value}, 10) || '{letter}')"


_U = f"least(u, {_then('e', 3, 'I')}, {_then('s', 3, 'I')}, {_then('a', 3, 'I')})"
_KEEP = "case when not gone and ini = '{}' then " + _then("{}", "more", "K") + " end"
_TURN = "case when not gone then " + _then("{}", "(3 + more)", "R") + " end"


@query(
    f"""
    with recursive c as (
        select *, xor(4294967295, list_reduce([4294967295::bigint] || list_transform(
            string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda v, z: case when v & 1 = 1 then xor(3988292384, v >> 1) else v >> 1 end))) % 20 w
        from conversations),
    x as (
        select conv_id, turn, case when w = 4 then 'user' else coalesce(role, ' ') end as role,
               case when w = 1 then '' when w = 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
               unnest(range(case when w = 3 then 2 else 1 end)) k
        from c where w <> 0),
    o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, k) i from x),
    f as (
        select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) body,
               row_number() over (partition by conv_id, role, text order by i) > 1 again, left(role, 1) ini from o),
    g as (
        select *, case when body = '' then 'b' when again then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end fault,
               lag(ini) over (partition by conv_id order by i) || ini pair from f),
    r as (select *, fault in ('b', 'd') gone, case when fault = 't' then 3 else 0 end more from g),
    step as (
        select distinct conv_id, 0::bigint i, '000000000' e, null::varchar s, null::varchar u, null::varchar a from conversations
        union all
        select conv_id, i, {_then('e', 4, 'D')},
               least({_then('s', 4, 'D')}, {_KEEP.format('s', *['e'] * 2)}),
               least({_then('u', 4, 'D')}, {', '.join(_KEEP.format('u', *[q] * 2) + ', ' + _TURN.format(*[q] * 2) for q in ('e', 's', 'a'))}),
               least({_then('a', 4, 'D')}, {_KEEP.format('a', *['u'] * 2)}, {_TURN.format(*['u'] * 2)})
        from (
            select r.conv_id, r.i, r.ini, r.gone, r.more, e, s, u, least(a, {_then('u', 3, 'I')}) a
            from (select conv_id, i, e, s, {_U} u, a from step) p join r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1)),
    best as (
        select conv_id, least(e, a, {_then('u', 3, 'I')}) z
        from (select conv_id, i, e, s, {_U} u, a from step) p
        qualify row_number() over (partition by conv_id order by i desc) = 1),
    cut as (select conv_id, substr(z, 1, 9)::bigint cost, substr(z, 10) audit from best),
    edit as (
        select conv_id, j, l, sum((l <> 'I')::int) over w n, sum((l <> 'D')::int) over w m
        from (select conv_id, unnest(range(1, length(audit) + 1)) j, substr(audit, j, 1) l from cut where audit <> '')
        window w as (partition by conv_id order by j)),
    kept as (
        select edit.conv_id, j, l, m, case when l = 'I' then '' else text end as text, case when l = 'K' then role end own,
               max((l = 'K' and m = 1 and ini = 's')::int) over (partition by edit.conv_id) led
        from edit left join r on r.conv_id is not distinct from edit.conv_id and r.i = n where l <> 'D'),
    made as (
        select conv_id, string_agg(coalesce(own, case when (m - led) % 2 = 1 then 'user' else 'assistant' end) || ':' || text, chr(10) order by j) t
        from kept group by 1),
    told as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'b') b,
               count(*) filter (fault = 'd') d, count(*) filter (fault = 't') t, count(*) filter (pair not in ('su', 'ua', 'au')) bad
        from r group by 1)
    select cut.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(b, 0)::bigint blank, coalesce(d, 0)::bigint duplicate,
           coalesce(told.t, 0)::bigint truncated, coalesce(bad, 0)::bigint illegal, cost, audit, sha256(coalesce(made.t, '')) repaired_sha256
    from cut left join told on told.conv_id is not distinct from cut.conv_id left join made on made.conv_id is not distinct from cut.conv_id
    """
)
def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    return repaired(damaged(table(spark, sf, "conversations")))
