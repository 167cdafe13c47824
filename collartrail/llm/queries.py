"""One query per operator over the whole of its table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    hyperminhash,
    lexical_index,
    line_crf,
    line_dedup,
    merkle,
    neighbours,
    pitman_yor,
    token_counts,
    token_files,
    toxicity,
)
from collartrail.llm.text import remainder_of_id
from collartrail.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document; rows with ``held_out`` taught nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = line_crf.document_quality(docs, labels.filter(remainder_of_id(4) != 2))
    return scored.select(
        "doc_id",
        (remainder_of_id(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document, written to seekable files and read back."""
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"),
        new_folder(spark, "token-files"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )
    return token_files.read_token_files(manifest)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that are in a window of a benchmark item."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("at_text")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of each document under the language model and under single words."""
    return pitman_yor.language_model_scores(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more share."""
    cleaned = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc.doc_id",
        "found.n_lines",
        "found.n_dropped",
        F.sha2("found.kept_text", 256).alias("kept_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of toxicity of each document; rows with ``held_out`` taught nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    taught = labels.filter(remainder_of_id(4) != 2)
    scored = toxicity.toxicity(docs.select("doc_id", "text"), docs, taught)
    return scored.select(
        "doc.doc_id",
        (remainder_of_id(4, "doc.doc_id") == 2).alias("held_out"),
        "found.severity",
        "found.p_toxic",
        "found.toxic",
    )


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays of those with equal text."""
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document and the bytes they decode to, as hashes."""
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op11_block_max_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    found = lexical_index.ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10
    )
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's proof, and whether a text without line ends still folds to the root."""
    tampered = F.when(even_crc32("doc_id"), F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


def even_crc32(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_token_files": op2_token_files,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_block_max_maxscore": op11_block_max_maxscore,
    "op12_learned_partitions": op12_learned_partitions,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _tree_sql(name: str, levels: int) -> str:
    """``{name}0(g, i, n, h)``, nodes and their number by group, climbed to ``{name}_top``; and
    ``{name}_path(g, i, lft, rgt)``, lists of the siblings' digests of each of them by level."""
    parts = []
    for k in range(levels):
        t, up = f"{name}{k}", f"{name}{k + 1}"
        parts.append(f"""
        {up} as materialized (
            select g, i // 3 as i, (max(n) + 2) // 3 as n,
                case when max(n) = 1 then max(h) else sha256(string_agg(h, '' order by i)) end as h
            from {t} group by g, i // 3
        ), {name}_run{k} as materialized (
            select a.g, a.i, coalesce(string_agg(b.h, '' order by b.i) filter (b.i < a.i), '') as lft,
                coalesce(string_agg(b.h, '' order by b.i) filter (b.i > a.i), '') as rgt
            from {t} a join {t} b on a.g is not distinct from b.g and a.i // 3 = b.i // 3
            where a.n > 1 group by a.g, a.i
        )""")
    joins = "".join(
        f" left join {name}_run{k} r{k} on r{k}.g is not distinct from t.g and r{k}.i = t.i // {3**k}"
        for k in range(levels)
    )
    sides = ", ".join(
        f"[{', '.join(f'r{k}.{side}' for k in range(levels))}] as {side}" for side in ("lft", "rgt")
    )
    parts.append(f"""
        {name}_top as (select g, h from {name}{levels}),
        {name}_path as materialized (select t.g, t.i, {sides} from {name}0 t{joins})""")
    return ",".join(parts)


def _merkle_sql(levels: int = 9) -> str:
    """Trees of up to 3 ** ``levels`` nodes, unrolled; a fold goes over the lists of siblings."""

    def leaf(text: str) -> str:
        fields = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    # DuckDB has no crc32: the polynomial, bit by bit
    crc = """xor(list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
            lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

    def fold(start: str, path: str) -> str:
        steps = f"list_filter(list_zip({path}.lft, {path}.rgt), lambda s: s[1] is not null)"
        return f"""list_reduce(
            [struct_pack(l := '', r := {start})] || list_transform({steps}, lambda s: struct_pack(l := s[1], r := s[2])),
            lambda a, b: struct_pack(l := '', r := sha256(b.l || a.r || b.r))).r"""

    def siblings(path: str) -> str:
        return f"list_aggregate(list_transform(list_zip({path}.lft, {path}.rgt), lambda s: coalesce(s[1] || s[2], '')), 'string_agg', '')"

    return f"""
        with leaves as materialized (
            select doc_id, source as g, {leaf("text")} as h,
                {leaf(f"case when {crc} % 2 = 0 then replace(text, chr(10), '') else text end")} as altered
            from documents
        ), placed as materialized (
            select *, row_number() over (partition by g order by doc_id) - 1 as i, count(*) over (partition by g) as n
            from leaves
        ), d0 as materialized (select g, i, n, h from placed),{_tree_sql("d", levels)},
        s0 as materialized (
            select 0 as g, row_number() over (order by g nulls first) - 1 as i, count(*) over () as n, h, g as name
            from d_top
        ),{_tree_sql("s", levels)}
        select p.doc_id, p.h as leaf, s0.h as subroot, root.h as root,
            sha256({siblings("d_path")} || {siblings("s_path")}) as proof_sha256,
            {fold(fold("p.altered", "d_path"), "s_path")} as folded_root,
            {fold(fold("p.altered", "d_path"), "s_path")} = root.h as verified
        from placed p join d_path on p.g is not distinct from d_path.g and p.i = d_path.i
            join s0 on s0.name is not distinct from p.g join s_path on s_path.i = s0.i, s_top root"""


SQL: dict[str, str] = {
    "op3_decontamination": r"""
        with doc as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), item as (
            select cast(item_id as varchar) as item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark
        ), item_window as (
            select distinct item, least(len(w), 13) as n,
                array_to_string(w[p : p + least(len(w), 13) - 1], ' ') as body
            from (select item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as p
                  from item where len(w) > 0)
        ), place as (
            select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as body
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
                  from doc, (select distinct n from item_window) where len(w) >= n)
        ), hit as (
            select doc_id, p, n, item from place join item_window using (n, body)
        ), hit_word as (
            select doc_id, count(distinct q) as n_hit
            from (select doc_id, unnest(range(p, p + n)) as q from hit) group by doc_id
        ), hit_item as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
            from (select distinct doc_id, item from hit) group by doc_id
        )
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            sha256(coalesce(names, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
        from doc left join hit_word using (doc_id) left join hit_item using (doc_id)""",
    "op6_line_dedup": r"""
        with lines as (
            select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
        ), keyed as (
            select doc_id, pos, line,
                translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
            from lines
        ), shared as (
            select k, max(doc_id) as last_id from keyed where length(k) >= 20
            group by k having count(distinct doc_id) >= 3
        ), marked as (
            select doc_id, pos, line, last_id is not null and doc_id < last_id as lost
            from keyed left join shared using (k)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
        from marked group by doc_id""",
    "op9_exact_dedup": r"""
        with bodies as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body
            from documents
        )
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id = min(doc_id) over same as kept, sha256(body) as text_sha256
        from bodies window same as (partition by body)""",
    "op11_block_max_maxscore": r"""
        with doc as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
            from documents
        ), size as (
            select count(*) filter (len(w) > 0) as all_docs, sum(len(w))::bigint as all_terms from doc
        ), item as (
            select item_id, term, count(*) as times
            from (select item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
            group by item_id, term
        ), held as (
            select doc_id, n, term, count(*) as tf
            from (select doc_id, len(w)::bigint as n, unnest(w) as term from doc)
            where term in (select term from item) group by doc_id, n, term
        ), weight as (
            select term, floor(1000 * ln((2 * all_docs::double + 2) / (2 * count(*) + 1)))::bigint as w
            from held, size group by term, all_docs
        ), scored as (
            select item_id, doc_id, sum(times * w * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 75 + (75 * n * all_docs) // all_terms))))::bigint as score
            from item join held using (term) join weight using (term), size group by item_id, doc_id
        )
        select item_id, rank::int as rank, doc_id, score
        from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
              from scored where score > 0)
        where rank <= 10""",
    "op13_merkle_manifest": _merkle_sql(),
}
