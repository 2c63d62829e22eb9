"""The operators of this folder as queries on whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.llm import bpe, collocations, exact_dedup, jaccard_join, line_crf, line_dedup, merkle, packing, quality_rules, secret_scan, substring_dedup, suffix_dedup, warc
from sparkdesk.llm.common import table

#: The vocabulary file of the tokenising queries.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def substring_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.drop_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def quality_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.quality(table(spark, folder, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *base, "base_failed", "kept")


def jaccard_query(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, folder, "documents"), VOCABULARY))


def line_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_chunks", F.sha2("text", 256).alias("kept_sha256"))


def classifier_query(spark: SparkSession, folder: str) -> DataFrame:
    return line_crf.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def secret_query(spark: SparkSession, folder: str) -> DataFrame:
    found, spans = secret_scan.secrets(table(spark, folder, "documents")), F.col("spans")
    kinds = {r.kind: i for i, r in enumerate(secret_scan.RULES)}
    count = lambda kind: F.size(F.filter(spans, lambda s: s["ord"] == kinds[kind])).cast("bigint")
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(spans, lambda s: s["ord"] < len([r for r in secret_scan.RULES if r.base]))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )


def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), VOCABULARY).drop("ids")


def exact_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


def merkle_query(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    proved = merkle.prove(*merkle.manifest(table(spark, folder, "documents"), tampered))
    told = lambda name: F.lower(F.hex(name))
    return proved.select(
        "doc_id", told("hash").alias("leaf"), told("subroot").alias("subroot"), told("root").alias("root"), told("proof").alias("proof_sha256"),
        told("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def collocation_query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def suffix_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffix_dedup.drop_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def pipeline_query(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_substring_dedup": substring_query,
    "op2_quality_rules": quality_rules_query,
    "op3_ngram_jaccard": jaccard_query,
    "op4_bpe": bpe_query,
    "op5_line_dedup": line_query,
    "op6_quality_classifier": classifier_query,
    "op7_secret_scan": secret_query,
    "op8_packing": packing_query,
    "op9_exact_dedup": exact_query,
    "op10_warc": warc_query,
    "op11_merkle": merkle_query,
    "op12_collocations": collocation_query,
    "op13_suffix_dedup": suffix_query,
    "pipeline": pipeline_query,
}

_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))


def _bounds_sql() -> str:
    broken = []
    for b in quality_rules.BOUNDS:
        sides = [f"{b.value} < {b.least}" if b.least is not None else "", f"{b.value} > {b.most}" if b.most is not None else ""]
        broken.append(f"(n_words >= {b.words} and {b.value.split(' / ')[1]} > 0 and ({' or '.join(filter(None, sides))}))")
    return " or ".join(broken)


def _rule_sql(ordinal: int, rule: secret_scan.Rule) -> str:
    # Runs are maximal anyway, so the guard before them is not needed; single quotes are doubled.
    pattern = rule.pattern.replace("(?<![0-9a-f])", "").replace("'", "''")
    return (
        f"select doc_id, '{rule.kind}' as kind, {ordinal} as ord, {rule.least} as least, regexp_extract_all(t, '{pattern}', 0) as a, "
        f"regexp_extract_all(t, '{pattern}', {rule.value}) as v, string_split_regex(t, '{pattern}') as g from d where regexp_matches(t, '{pattern}')"
    )


#: CRC-32 of the ASCII text ``t``, as DuckDB has none.
_CRC = (
    "xor(list_reduce([4294967295::bigint] || list_transform(string_split(t, ''), lambda x: ord(x)::bigint), lambda crc, byte: xor(crc >> 8, "
    "list_reduce([(xor(crc, byte) & 255)] || [0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))), 4294967295)"
)


def _merkle_sql(levels: int = 7, top: int = 2) -> str:
    """The trees level by level; a tree of one node stays as it is. ``levels`` and ``top`` suffice for 2 million documents of a language in 64 of them."""
    told = lambda c: f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}, '-')"
    leaf = lambda text: f"sha256({' || '.join([told(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [told(text)])})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"c as (select *, {_CRC} % 3 = 0 as tampered from (select *, doc_id::varchar as t from documents))",
        f"h as (select doc_id, lang as g, {leaf('text')} as h, case when tampered then {leaf(lower)} else {leaf('text')} end as seen from c)",
        "p0 as (select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as i from h)",
        "n0 as (select g, i, h, count(*) over (partition by g) as c from p0)",
        "f0 as (select doc_id, g, i, seen as cur, '' as proof, h as leaf from p0)",
    ]

    def rise(n: str, f: str, l: int) -> None:
        steps.append(f"r{n}{l} as (select g, i // 8 as i, list(h order by i) as run, max(c) as c from {n}{l} group by g, i // 8)")
        steps.append(f"{n}{l + 1} as (select g, i, case when c = 1 then run[1] else sha256(array_to_string(run, '')) end as h, count(*) over (partition by g) as c from r{n}{l})")
        steps.append(
            f"{f}{l + 1} as (select {f}{l}.* exclude (cur, proof, i), r.i as i, case when c = 1 then cur else "
            f"sha256(array_to_string(run[: {f}{l}.i % 8] || [cur] || run[{f}{l}.i % 8 + 2 :], '')) end as cur, "
            f"case when c = 1 then proof else proof || array_to_string(run[: {f}{l}.i % 8] || run[{f}{l}.i % 8 + 2 :], '') end as proof "
            f"from {f}{l} join r{n}{l} r on {f}{l}.g is not distinct from r.g and {f}{l}.i // 8 = r.i)"
        )

    for level in range(levels):
        rise("n", "f", level)
    steps.append(f"t0 as (select 0 as g, row_number() over (order by g nulls first) - 1 as i, h, g as name, count(*) over () as c from n{levels})")
    steps.append(f"u0 as (select doc_id, leaf, h as subroot, 0 as g, t0.i, cur, proof from f{levels} f join t0 on f.g is not distinct from t0.name)")
    for level in range(top):
        rise("t", "u", level)
    return (
        f"with {', '.join(steps)} select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, cur as folded_root, cur = h as verified "
        f"from u{top}, t{top}"
    )


ORACLE = {
    "op11_merkle": _merkle_sql(),
    "op13_suffix_dedup": f"""
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        s as (select doc_id, i, substr(h, 2 * i + 1, {2 * suffix_dedup.LENGTH}) as x
            from (select doc_id, h, unnest(range(0, greatest(len(h) // 2 - {suffix_dedup.LENGTH - 1}, 0))) as i from d)),
        f as (select x, min(doc_id) as first from s group by x having count(*) > 1),
        gone as (select distinct doc_id, unnest(range(i, i + {suffix_dedup.LENGTH})) as p from s join f using (x) where doc_id > first),
        runs as (select doc_id, count(*) as n, count(*) filter (lag is null or lag < p - 1) as spans
            from (select doc_id, p, lag(p) over (partition by doc_id order by p) as lag from gone) group by doc_id),
        b as (select doc_id, unnest(range(0, len(h) // 2)) as p, h from d),
        kept as (select doc_id, string_agg(substr(h, 2 * p + 1, 2), '' order by p) as k from b anti join gone using (doc_id, p) group by doc_id)
        select d.doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
            sha256(unhex(coalesce(k, ''))) as kept_sha256 from d left join runs using (doc_id) left join kept using (doc_id)""",
    "op12_collocations": rf"""
        with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        p as (select lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?
-
]')), '[^ 	]+') as ws from t),
        n as (select lang, sum(len(ws)) as n from p group by lang),
        g as (select lang, k, ws, unnest(range(1, len(ws) - k + 2)) as i from p, (select unnest(range(1, 6)) as k) where len(ws) >= k),
        f as (select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase, count(*) as a from g group by all having count(*) >= 100),
        w as (select *, string_split(phrase, ' ') as ws from f where k > 1),
        inner_ as (select lang, a, k, array_to_string(ws[i : i + m - 1], ' ') as phrase from
            (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from w))),
        c as (select * from w where not exists (select 1 from inner_ x where x.lang = w.lang and x.phrase = w.phrase and x.a >= w.a)),
        cut as (select *, unnest(range(1, k)) as j from c),
        s as (select cut.*, x.a as l, y.a as r, n.n, (1000::hugeint * cut.a * n.n) // (x.a::hugeint * y.a) as score from cut
            join f x on x.lang = cut.lang and x.phrase = array_to_string(cut.ws[: j], ' ')
            join f y on y.lang = cut.lang and y.phrase = array_to_string(cut.ws[j + 1 :], ' ') join n on n.lang = cut.lang),
        low as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank, phrase, a::bigint as a, l::bigint as l,
            r::bigint as r, n::bigint as n, score::bigint as score from low qualify rank <= {collocations.TOP}""",
    "op1_substring_dedup": f"""
        with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
        windows as (select doc_id, i, array_to_string(ws[i : i + {substring_dedup.WINDOW - 1}], ' ') as k
            from (select doc_id, ws, unnest(range(1, greatest(len(ws) - {substring_dedup.WINDOW - 2}, 1))) as i from w)),
        later as (select doc_id, i from (select *, row_number() over (partition by k order by doc_id, i) as r from windows) where r > 1),
        gone as (select distinct doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) as p from later),
        words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w),
        kept as (select words.doc_id, string_agg(word, ' ' order by p) as t from words anti join gone using (doc_id, p) group by words.doc_id),
        n as (select doc_id, count(*) as n from gone group by doc_id)
        select w.doc_id, len(ws)::bigint as n_words, coalesce(n.n, 0)::bigint as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
        from w left join n using (doc_id) left join kept using (doc_id)""",
    "op2_quality_rules": rf"""
        with d as (select doc_id, coalesce(text, '') as t from documents),
        w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
        windows as (select doc_id, i, array_to_string(ws[i : i + 7], ' ') as k
            from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 6, 1))) as i from w)),
        twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, k) as n from windows) where n > 1),
        covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
        m as (select w.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
            (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
            len(ls) as n_lines, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) as n_upper,
            len(list_filter(ls, lambda x: length(x) < 4 * length(regexp_replace(x, '[^|#*$%&<>!]+', '', 'g')))) as n_symbol_lines,
            len(list_filter(ws, lambda x: x in ({_STOP}))) as n_stop_words
            from w left join covered using (doc_id)),
        b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({_bounds_sql()}) as kept from b""",
    "op7_secret_scan": f"""
        with d as (select doc_id, coalesce(text, '') as t from documents),
        m as ({" union all ".join(_rule_sql(i, r) for i, r in enumerate(secret_scan.RULES))}),
        e as (select *, unnest(range(1, len(a) + 1)) as i from m),
        s as (select doc_id, kind, ord, length(a[i]) as n, list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(a[1:i - 1], lambda x: length(x))), 0) as start from e where length(v[i]) >= least),
        f as (select doc_id, ord, start, kind || ':' || start::bigint || ':' || (start + n)::bigint as span from s),
        g as (select doc_id, count(*) filter (ord = 0) as n_assign, count(*) filter (ord = 1) as n_access, count(*) filter (ord = 2) as n_hex,
            string_agg(span, ',' order by start, ord) filter (ord < 3) as base, string_agg(span, ',' order by start, ord) as spans from f group by doc_id)
        select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
            sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join g using (doc_id)""",
    "op9_exact_dedup": r"""
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x from documents)
        select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, sha256(x) as text_sha256
        from t window w as (partition by x)""",
    "op10_warc": f"""
        with p as (select page_id, coalesce(html, '') as h from pages),
        q as (select page_id, octet_length(encode(h))::bigint as n, sha256(h) as s, min(page_id) over (partition by h) as first from p)
        select page_id, n as payload_bytes, s as payload_digest,
            case when n >= {warc.LEAST_REVISIT} and first != page_id then 'revisit' else 'response' end as record_type,
            case when n >= {warc.LEAST_REVISIT} and first != page_id then first end as refers_to from q""",
}
