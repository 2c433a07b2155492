"""Registered queries of the operators over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from pavilion.llm import bpe, decontaminate, html_text, importance, line_dedup, quality_fm, quality_rules, sentence_pieces, sharding, simhash, suffix_dedup, url_filter, whitening
from pavilion.llm.common import table


def op1_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op2_line_dedup(spark, sf):
    """Positions of dropped lines, and the documents that keep one of each, as texts."""
    rows = line_dedup.report(table(spark, sf, "documents"))
    return rows.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("dropped", "classes")})


def op3_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"))


def op4_byte_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


def op5_suffix_dedup(spark, sf):
    return suffix_dedup.report(table(spark, sf, "documents"))


def op6_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"))


def op8_html_text(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


def op9_decontamination(spark, sf):
    return decontaminate.judge(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_quality_classifier(spark, sf):
    return quality_fm.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


def op12_importance_resampling(spark, sf):
    rows = importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_sentence_pieces(spark, sf):
    return sentence_pieces.digests(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def queries():
    own = (
        op1_simhash, op2_line_dedup, op3_url_filter, op4_byte_bpe, op5_suffix_dedup, op6_quality_rules, op7_sharding, op8_html_text,
        op9_decontamination, op10_quality_classifier, op11_whitening, op12_importance_resampling, op13_sentence_pieces,
    )
    return {query.__name__: query for query in own}


def url_filter_sql() -> str:
    """Each pattern rule tried on each URL, without an index."""
    longest = sorted(url_filter.HOST_RULES, key=lambda r: -len(r[0] + r[1]))

    def fits(host, path):
        return f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"

    def cases(values, otherwise):
        return "case " + " ".join(f"when {test} then {value}" for test, value in values) + f" else {otherwise} end"

    ranked = sorted(enumerate(url_filter.PATTERN_RULES), key=lambda r: (r[1][2], r[0]))
    tried = [(f"regexp_matches(low, '{pattern}')", (f"'{pattern}'", f"'{verdict}'")) for _, (pattern, _, verdict) in ranked]
    rule = cases([(fits(h, p), f"'{h}{p}'") for h, p, _ in longest], "null")
    ruled = cases([(fits(h, p), f"'{v}'") for h, p, v in longest], "null")
    pattern = cases([(test, values[0]) for test, values in tried], "null")
    matched = cases([(test, values[1]) for test, values in tried], "'allow'")
    return f"""
        with cut as (
            select page_id, url, position('://' in coalesce(url, '')) as found,
                lower(coalesce(url, '')) as low from pages),
        parts as (
            select page_id, url, low,
                case when found > 0 then translate(regexp_extract(substr(url, found + 3), '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
                case when found > 0 then regexp_extract(substr(url, found + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
            from cut),
        ruled as (select *, {rule} as rule, {ruled} as decided from parts)
        select page_id, url, host, path, rule, coalesce(decided, {matched}) as verdict,
            case when decided is null then {pattern} end as pattern
        from ruled"""


LINES = f"""
    with recursive lines as (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos
        from documents),
    forms as (select doc_id, pos, trim(line, ' ') as form from lines where length(trim(line, ' ')) > 0),
    texts as (select distinct form, length(form) as n from forms where length(form) >= {line_dedup.MIN_CHARS}),
    -- One edit spares the first nine characters or the last nine.
    links as (
        select a.form as u, b.form as v from texts a join texts b on a.form[1:9] = b.form[1:9]
            and b.n between a.n - 1 and a.n + 1 and a.form <> b.form and levenshtein(a.form, b.form) <= 1
        union
        select a.form, b.form from texts a join texts b on right(a.form, 9) = right(b.form, 9)
            and b.n between a.n - 1 and a.n + 1 and a.form <> b.form and levenshtein(a.form, b.form) <= 1),
    reach as (select distinct u as form, u as other from links union select r.form, l.v from reach r join links l on l.u = r.other),
    roots as (select form, min(other) as root from reach group by form),
    placed as (
        select doc_id, pos, first_value(doc_id) over w as keeper,
            row_number() over w > 1 as gone
        from forms left join roots using (form)
        window w as (partition by coalesce(root, form) order by doc_id, pos)),
    gone as (
        select doc_id, count(*) as n_dropped, string_agg(cast(pos as varchar), ',' order by pos) as dropped,
            string_agg(cast(keeper as varchar), ',' order by pos) as classes
        from placed where gone group by doc_id)
    select doc_id, coalesce(len(string_split(text, chr(10))), 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
        coalesce(dropped, '') as dropped, coalesce(classes, '') as classes
    from documents left join gone using (doc_id)"""

WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

WINDOWS = f"""
    with docs as (select doc_id, {WORDS} as w from documents),
    items as (select item_id, {WORDS} as w from benchmark where item_id is not null),
    sized as (select item_id, w, least({decontaminate.SPAN}, len(w)) as n from items where len(w) > 0),
    asked as (
        select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as words
        from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)),
    sizes as (select distinct n from sized),
    found as (
        select doc_id, i, d.n, item_id
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs cross join sizes) d
        join asked a on a.n = d.n and a.words = array_to_string(w[i : i + d.n - 1], ' ')),
    covered as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from found)) group by doc_id),
    named as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from docs left join covered using (doc_id) left join named using (doc_id)"""


# crc32 byte by byte, over a table of the 256 remainders; once for each distinct word.
RESAMPLED = f"""
    with docs as (select doc_id, {WORDS} as w from documents),
    remainders as (
        select list(r order by b) as t from (
            select b, list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) as r
            from range(256) x(b))),
    words as (select distinct unnest(w) as word from docs union select distinct unnest({WORDS}) from benchmark),
    spelt as (select word, hex(encode(word)) as h from words),
    hashed as (
        select word, xor(4294967295, list_reduce(
            list_transform(range(len(h) // 2), lambda i: cast('0x' || substr(h, 2 * i + 1, 2) as bigint)),
            lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295)) % {importance.BUCKETS} as bucket
        from spelt, remainders),
    found as (select doc_id, bucket from (select doc_id, unnest(w) as word from docs) join hashed using (word)),
    asked as (select bucket from (select unnest({WORDS}) as word from benchmark) join hashed using (word)),
    sums as (select (select count(*) from found) as s_all, (select count(*) from asked) as t_all),
    gains as (
        select bucket, cast(floor({importance.SCALE} * ln((coalesce(t, 0) + 1.0::double) * (s_all + {importance.BUCKETS})::double
            / ((s + 1.0::double) * (t_all + {importance.BUCKETS})::double))) as bigint) as gain
        from (select bucket, count(*) as s from found group by bucket)
        left join (select bucket, count(*) as t from asked group by bucket) using (bucket), sums),
    summed as (select doc_id, count(*) as n, sum(gain) as total from found join gains using (bucket) group by doc_id),
    scored as (
        select doc_id, len(w) as n_features,
            case when n > 0 then (total - ((total % n) + n) % n) // n else 0 end as weight,
            cast('0x' || substr(sha256('{importance.SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
        from docs left join summed using (doc_id)),
    noised as (
        select doc_id, n_features, weight,
            weight + cast(floor(-{importance.SCALE} * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score
        from scored),
    ranked as (
        select doc_id, row_number() over (order by score desc, doc_id) as place, {importance.PERCENT} * count(*) over () // 100 as drawn
        from noised where n_features >= {importance.MIN_WORDS})
    select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
        case when place <= drawn then place end as rank
    from noised left join ranked using (doc_id)"""


def oracle_sql():
    return {"op12_importance_resampling": RESAMPLED, "op2_line_dedup": LINES, "op3_url_filter": url_filter_sql(), "op9_decontamination": WINDOWS}
