"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import (
    decontaminate, language, licenses, line_dedup, lm_score, near_dups, packing, personal_data, prefix_trie, quality,
    ranked_search, sharding, token_ids,
)
from clickloom.llm.common import crc_of_id, documents


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (crc_of_id(7) == 2).alias("held_out")
    return lm_score.score(documents(spark, sf_dir).select("doc_id", "text", held_out))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    return found.withColumn("n_blocks", F.size("blocks").cast("long")).drop("blocks")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_of_id(5) == 0, F.lit(False))
    model = language.fit(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    written = token_ids.write_ids(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return token_ids.with_starts(token_ids.read_ids(written))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number_of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return personal_data.find(documents(spark, sf_dir)).select(
        "doc_id",
        *[number_of(kind) for kind in personal_data.KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op12_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_context_tree": op4_context_tree,
    "op5_quality_rules": op5_quality_rules,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_lsh_forest": op8_lsh_forest,
    "op9_token_ids": op9_token_ids,
    "op10_sharding": op10_sharding,
    "op11_disclosure_sanitisation": op11_disclosure_sanitisation,
    "op12_fp_tree_search": op12_fp_tree_search,
    "op13_prefix_trie": op13_prefix_trie,
}


# CRC-32 in SQL, from its polynomial: the table of all bytes, and the checksum of a list ``b`` of bytes.
CRC_TABLE = """crc_table as (
            select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: if(c % 2 = 1, xor(c >> 1, 3988292384), c >> 1))) as t
        )"""


def crc32_sql(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])))"


def template_values() -> str:
    lines = {label: b" ".join(licenses.words_of(text)).decode() for label, text in licenses.TEMPLATES.items()}
    return ", ".join(f"('{label}', '{line}')" for label, line in lines.items())


ORACLE: dict[str, str] = {
    "op3_line_dedup": r"""
        with cut as (
            select doc_id, u.i as n, u.line as line
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents) d,
                 lateral (select unnest(lines) as line, generate_subscripts(lines, 1) as i) u
        ), keyed as (
            select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from cut
        ), shared as (
            select key, min(doc_id) as first_doc from keyed where length(key) >= 10
            group by key having min(doc_id) < max(doc_id)
        ), judged as (
            select k.doc_id, k.n, k.line, s.key is not null and k.doc_id > s.first_doc as lost
            from keyed k left join shared s using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by n) filter (where not lost), '')) as kept_sha256
        from judged group by doc_id
    """,
    "op5_quality_rules": r"""
        with words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
        ), spans as (
            select doc_id, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] as span
            from words, unnest(range(1, len(w) - 1)) as r(i)
        ), again as (
            select doc_id, i from spans qualify count(*) over (partition by doc_id, span) > 1
        ), covered as (
            select doc_id, count(distinct i + k) as n_repeat_words
            from again, unnest([0, 1, 2]) as o(k) group by doc_id
        ), rows_of as (
            select doc_id, list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l
            from documents
        ), counted as (
            select d.doc_id, coalesce(d.lang, '') as stratum, len(w) as n_words,
                cast(length(regexp_replace(coalesce(d.text, ''), '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
                cast(length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
                cast(length(regexp_replace(coalesce(d.text, ''), '[^A-Z]+', '', 'g')) as bigint) as n_capitals,
                len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
                coalesce(n_repeat_words, 0) as n_repeat_words
            from documents d join words using (doc_id) join rows_of using (doc_id) left join covered using (doc_id)
        ), judged as (
            select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, map {
                'symbol_share': if(word_chars > 0, n_symbols / word_chars, 0),
                'dup_line_share': if(n_lines > 0, n_dup_lines / n_lines, 0),
                'repeat_share': if(n_words > 0, n_repeat_words / n_words, 0),
                'capital_share': if(word_chars > 0, n_capitals / word_chars, 0),
                'mean_word_chars': if(n_words > 0, word_chars / n_words, 0)} as signals
            from counted
        ), candidates as (
            select signal, unnest([0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5])::double as cutoff
            from unnest(['symbol_share', 'dup_line_share', 'repeat_share', 'capital_share']) as s(signal)
            union all
            select 'mean_word_chars', unnest([8, 9, 10, 12, 15, 20, 30, 50, 100])::double
        ), holdout as (
            select stratum, signals from judged
            where not base_failed and doc_id in (select doc_id from labels group by doc_id having min(quality) = 1)
        ), tests as (
            select stratum, signal, cutoff, count(*) as n, count(*) filter (where signals[signal] >= cutoff) as k
            from holdout, candidates group by all
        ), certified as (
            select stratum, signal, min(cutoff) as cutoff from tests
            where k < n * 0.01 and (
                select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))
                from unnest(range(k + 1)) as r(i)
            ) <= 0.05 / (45 * (select count(distinct stratum) from judged))
            group by stratum, signal
        )
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not base_failed and not exists (
                select 1 from certified c where c.stratum = j.stratum and j.signals[c.signal] >= c.cutoff
            ) as kept
        from judged j
    """,
    "op6_license_scan": r"""
        with words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), phrases(label, p) as (values
            ('gpl', ['gnu', 'general', 'public', 'license']), ('apache', ['apache', 'license']),
            ('cc-by', ['cc', 'by']), ('mit', ['mit', 'license'])
        ), starts as (
            select doc_id, label, i
            from words, unnest(range(len(w))) as r(i), phrases where w[i + 1 : i + len(p)] = p
        ), base as (
            select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word,
                string_agg(distinct label, ',' order by label) as base_labels
            from starts group by doc_id
        ), templates(label, t, step) as (
            select label, list_distinct(w), greatest(32, 2 ** ceil(log2(len(w))))::bigint from (
                select label, string_split(line, ' ') as w from (values @TEMPLATES@) as v(label, line))
        ), blocks as (
            select doc_id, label, len(list_intersect(list_distinct(w[b + 1 : b + 2 * step]), t)) / len(t) as share
            from words, templates, unnest(range(0, len(w), step)) as r(b)
        ), held as (select * from blocks where share >= 0.85),
        scored as (select doc_id, count(*) as n_blocks, max(share) as score from held group by doc_id),
        named as (
            select doc_id, string_agg(distinct label, ',' order by label) as labels
            from (select doc_id, label from held union all select doc_id, label from starts) group by doc_id
        )
        select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
            coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
            if(n_base > 0, 1.0::double, coalesce(score, 0)) as score, coalesce(n_blocks, 0) as n_blocks
        from words left join base using (doc_id) left join scored using (doc_id) left join named using (doc_id)
    """.replace("@TEMPLATES@", template_values()),
    "op8_lsh_forest": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as w
            from documents
        ), sets as (
            select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
            from words, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as r(i)
        ), sizes as (select doc_id, count(*) as n from sets group by doc_id),
        links as (
            select a.doc_id as a, b.doc_id as b
            from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            join sizes na on na.doc_id = a.doc_id join sizes nb on nb.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, na.n, nb.n
            having 100 * count(*) >= 75 * (na.n + nb.n - count(*))
        ), reached as (
            select doc_id, doc_id as met from documents
            union
            select doc_id, b as met from reached join links on met = a
        )
        select doc_id, coalesce(n, 0) as n_shingles, min(met) as component_id, doc_id = min(met) as kept
        from reached left join sizes using (doc_id) group by doc_id, n
    """,
    "op10_sharding": f"""
        with {CRC_TABLE}, sized as (
            select doc_id, coalesce(strlen(text), 0) + 8 as size, {crc32_sql("coalesce(text, '')")} as text_crc32
            from documents, crc_table
        ), laid as (
            select *, coalesce(sum(size) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as before,
                sum(size) over () as total
            from sized
        ), dealt as (
            select *, ((2 * before + size) * 24 // (2 * total))::integer as shard from laid
        )
        select doc_id, size, text_crc32, 'bytes' as law, shard,
            row_number() over (partition by shard order by doc_id) - 1 as slot, null::integer as grown_shard
        from dealt
    """,
    "op12_fp_tree_search": r"""
        with terms as (
            select row_number() over () as r, doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ), sizes as (select r, doc_id, count(*) as n from terms group by r, doc_id),
        total as (select count(*) as docs, sum(n)::bigint as all_terms from sizes),
        held as (select r, term, count(*) as tf from terms group by r, term),
        wanted as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ), weights as (
            select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
            from held, total group by term, docs
        ), scored as (
            select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms))))::bigint as score
            from wanted join weights using (term) join held using (term) join sizes using (r), total
            group by item_id, doc_id, r
        )
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id nulls first))::integer as rank, doc_id, score
        from scored where score > 0 qualify rank <= 50
    """,
    "op13_prefix_trie": f"with {CRC_TABLE}," + r"""
        turns as (
            select conv_id, list({'id': id, 'words': words} order by turn nulls first, id) as t
            from (
                select conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words,
                    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id
                from conversations where conv_id is not null
            ) group by conv_id
        ), lent as (
            select conv_id, turns.t, """ + crc32_sql("conv_id::varchar").replace("t[", "crc_table.t[") + r""" % 4 as h from turns, crc_table
        ), rebuilt as (
            select c.conv_id, list_concat(coalesce(b.t[1 : h], c.t[1 : 0]), c.t[h + 1 :]) as t
            from lent c left join turns b on b.conv_id = c.conv_id - c.conv_id % 20
        ), members as (
            select conv_id, d as depth, list_transform(t[1 : d], lambda x: x.id) as p, t[d].words as w, len(t) = d as ended
            from rebuilt, unnest(range(len(t) + 1)) as r(d)
        ), nodes as (
            select depth, p, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(w), 0) as w,
                sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ended), '')) as ends_sha256
            from members group by depth, p
        ), kids as (
            select p[1 : depth - 1] as p, count(*) as n from nodes where depth > 0 group by all
        ), sums as (
            select n.p[1 : d] as p, count(*) filter (where k.n is null) as n_leaves, sum((n_convs - 1) * w)::bigint as saved_tokens
            from nodes n left join kids k using (p), unnest(range(depth + 1)) as r(d) group by all
        )
        select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, n_leaves,
            saved_tokens, n.ends_sha256
        from nodes n join sums s on s.p = n.p left join kids k on k.p = n.p
        left join nodes u on n.depth > 0 and u.p = n.p[1 : n.depth - 1]
    """,
}
