"""The document operators over the driver's tables, each next to its checking SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import classifier, exact, forest, jaccard, licences, merkle, mixing, packing, quality, sharding, spelling, suffix, tokens
from strata.llm.common import table

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality_rules(spark, sf):
    rated = quality.assess(table(spark, sf, "documents"))
    base = [rule.test(F.col) for rule in quality.BASE_RULES]
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (base[0] | base[1]).alias("base_failed"), "kept", "n_lines", "n_marks", "n_stutters")


ORACLES["op1_quality_rules"] = r"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
runs as (select doc_id, i, array_to_string(w[i:i+7], ' ') as run from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d)),
twice as (select doc_id, i from runs where run is not null qualify count(*) over (partition by doc_id, run) > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
s as (
  select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
         cast(len(l) as bigint) as n_lines, cast(length(regexp_replace(text, '[^!?]', '', 'g')) as bigint) as n_marks,
         cast(len(list_filter(list_zip(w[2:], w[:-2]), lambda x: x[1] = x[2])) as bigint) as n_stutters
  from d left join rep on rep.doc_id = d.doc_id)
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 100 * n_symbols > 20 * n_words or 100 * n_stutters > 20 * n_words
            or n_dup_lines > 3 and 100 * n_dup_lines > 30 * n_lines or 100 * n_marks > 50 * n_words or word_chars > 15 * n_words or word_chars < 2 * n_words) as kept
from s"""

MIX_WEIGHTS = [3, 1, 2]


@query
def op2_mixing(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"), lambda sizes: mixing.cyclic_weights(sizes, MIX_WEIGHTS))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op2_mixing"] = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), md5(text), '')) as h from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, [3, 1, 2][1 + cast((row_number() over (order by source nulls last) - 1) % 3 as integer)] as weight
  from d group by source),
b as (select 1.5::double * sum(size) as budget from d),
-- sources by the level at which they are full; the level is reached with the first k of them full
l as (
  select s.*, 2.0::double * source_size as cap, coalesce(sum(2 * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as caps_before,
         sum(weight) over (o rows between current row and unbounded following) as weight_left
  from s window o as (order by 2.0::double * source_size / weight, source)),
level as (
  select arg_min((budget - caps_before) / weight_left, cap / weight) as level from l, b
  where 2.0::double * source_size / weight > (budget - caps_before) / weight_left),
t as (
  select source, source_size, case when cap <= coalesce(level, 'infinity'::double) * weight then cap else level * weight end as target from l, level),
c as (
  select doc_id, d.source, h, size, source_size, target,
         sum(size) over (partition by d.source order by h, doc_id, size rows unbounded preceding) as cum
  from d join t on d.source is not distinct from t.source),
copies as (
  select doc_id, source, size, epoch, (cum + epoch * source_size) / target as finish
  from c, (values (0), (1)) as e(epoch) where size > 0 and target > 0),
taken as (
  select doc_id, sum(size) as taken from (
    select *, sum(size) over (order by finish, source nulls first, epoch rows unbounded preceding) as total from copies) as q, b
  where total <= budget group by doc_id)
select c.doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken from c left join taken using (doc_id)"""


@query
def op7_exact_dedup(spark, sf):
    decided = exact.dedupe_batch(table(spark, sf, "documents"), exact.fresh_index())
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op7_exact_dedup"] = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from d"""


TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 2048


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_token_counts(spark, sf):
    counted = tokens.token_counts(table(spark, sf, "documents"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query
def op6_quality_classifier(spark, sf):
    return classifier.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


SHARDS = [f"shard-{i:03d}" for i in range(96)]


@query
def op9_sharding(spark, sf):
    placed = sharding.assign_shards(table(spark, sf, "documents"), SHARDS)
    return placed.select("row.doc_id", "row.source", "slot", "shard", F.coalesce(F.octet_length("row.text"), F.lit(0)).alias("n_bytes"))


@query
def op10_ngram_jaccard(spark, sf):
    return jaccard.similar_groups(table(spark, sf, "documents"))


@query
def op5_suffix_dedup(spark, sf):
    return suffix.remove_repeats(table(spark, sf, "documents")).drop("kept_bytes")


def as_files(docs):
    """Documents as files: below each source a directory for a thousand ids, in it one for each hundred of them.

    Every eleventh id is named as a licence file of the upper directory; it gives a licence only if its text holds a notice.
    """
    upper, lower = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    named = F.concat_ws("/", F.col("source"), upper, F.concat(F.lit("LICENSE-"), name))
    return docs.withColumn("path", F.when(F.col("doc_id") % 11 == 0, named).otherwise(F.concat_ws("/", F.col("source"), upper, lower, name)))


@query
def op3_licence_scan(spark, sf):
    return licences.scan(as_files(table(spark, sf, "documents")))



@query
def op11_spelling_variants(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"), divisor=199)


ORACLES["op11_spelling_variants"] = r"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
each as (select doc_id, run, count(*) as n from runs group by all),
-- CRC-32 of the UTF-8 bytes, bit by bit
hashed as (
  select run, n, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(1, octet_length(b) + 1), lambda k: cast('0x' || substr(hex(b), 2 * k - 1, 2) as bigint))),
           lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda y, i: xor(y >> 1, case when y & 1 = 1 then 3988292384::bigint else 0::bigint end))), 4294967295::bigint) as h
  from (select run, n, encode(coalesce(cast(doc_id as varchar), '') || ':' || run) as b from each)),
changed as (select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from changed group by word having length(word) >= 6 and sum(n) >= 5),
less as (select word, n, i, word[:i - 1] || word[i + 1:] as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other, b.n as m from less as a join less as b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from less as a join words as b on a.rest = b.word
  union select b.word, a.word, a.n from less as a join words as b on a.rest = b.word),
best as (select word, count(*) as n_near, arg_min(other, (-m, other)) as other, max(m) as m from near group by word),
rated as (
  select words.word, n, coalesce(n_near, 0) as n_near, case when m >= 5 * n then other end as form, case when m >= 5 * n then m end as form_n
  from words left join best using (word)),
walk as (select word, word as root from rated union all select walk.word, form from walk join rated on rated.word = walk.root where form is not null),
ends as (select walk.word, walk.root from walk join rated on rated.word = walk.root where rated.form is null)
select word, form, root, n, n_near, form_n from rated join ends using (word)"""



@query
def op12_minhash_forest(spark, sf):
    return forest.near_duplicates(table(spark, sf, "documents"))


ORACLES["op12_minhash_forest"] = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, case when len(w) = 1 then w else w[i:i + 1] end as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n from s group by doc_id),
-- a set is known by its sorted shingles; equal sets are one class, which its smallest id stands for
sets as (select doc_id, hash(list(shingle order by shingle)) as h, count(*) as n from s group by doc_id),
classes as (select min(doc_id) as class, h, n from sets group by h, n),
t as (select class, n, shingle from s join classes on s.doc_id = classes.class),
pairs as (
  select a.class as a, b.class as b from t as a join t as b on a.shingle = b.shingle and a.class < b.class and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n
  group by a.class, b.class, a.n, b.n having 180 * count(*) >= 80 * (a.n + b.n)),
edges as (select a, b from pairs union all select b, a from pairs),
reach as (select class as node, class as other from classes union select node, b from reach join edges on other = a),
comps as (select node, min(other) as comp from reach group by node)
select d.doc_id, coalesce(sets.n, 0) as n_shingles, coalesce(comp, d.doc_id) as component_id, coalesce(comp, d.doc_id) = d.doc_id as kept
from d left join sets using (doc_id) left join classes using (h, n) left join comps on node = class"""


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op13_merkle_manifest(spark, sf):
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    claims = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    checked = merkle.verify(table(spark, sf, "documents"), MANIFEST_FIELDS, "lang", "doc_id", claims)
    return checked.select(
        F.col("id").cast("bigint").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# CRC-32 has no SQL function: bytes are folded in bit by bit.
ORACLES["op13_merkle_manifest"] = r"""
with recursive d as (
  select row_number() over (order by doc_id nulls first) as r, doc_id, coalesce('=' || lang, '') as g, source, lang, n_chars, text,
         xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, case when x & 1 = 1 then 3988292384::bigint else 0::bigint end))), 4294967295::bigint) as crc
  from documents),
claims as (select *, case when crc % 7 = 0 then n_chars + 1 else n_chars end as claimed from d),
parts as (
  select r, doc_id, g, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as a,
         coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as own, coalesce(strlen(cast(claimed as varchar)) || ':' || claimed, '-') as other,
         coalesce(strlen(text) || ':' || text, '-') as z from claims),
leaves as (select doc_id, g, sha256(a || own || z) as h, sha256(a || other || z) as claim, row_number() over (partition by g order by doc_id nulls first, sha256(a || own || z)) - 1 as i from parts),
inner_nodes as (
  select g, 0 as l, i, h, count(*) over (partition by g) as n from leaves
  union all select g, l + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from inner_nodes where n > 1 group by g, l, i // 2, n),
tops as (select g, h, row_number() over (order by g) - 1 as i from inner_nodes where n = 1),
outer_nodes as (
  select 0 as l, i, h, count(*) over () as n from tops
  union all select l + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from outer_nodes where n > 1 group by l, i // 2, n),
up as (
  select t.g, t.h as subroot, coalesce(list(case when s.i is null then '' when s.i < t.i >> o.l then 'L' || s.h else 'R' || s.h end order by o.l) filter (o.l is not null), []) as path
  from tops as t left join (select distinct l from outer_nodes where n > 1) as o on true
  left join outer_nodes as s on s.l = o.l and s.i = xor(t.i >> o.l, 1) group by t.g, t.h),
down as (
  select e.g, e.i, e.doc_id, e.h, e.claim, coalesce(list(case when s.i is null then '' when s.i < e.i >> o.l then 'L' || s.h else 'R' || s.h end order by o.l) filter (o.l is not null), []) as path
  from leaves as e left join (select distinct g, l from inner_nodes where n > 1) as o on o.g = e.g
  left join inner_nodes as s on s.g = e.g and s.l = o.l and s.i = xor(e.i >> o.l, 1) group by all),
folded as (
  select doc_id, h as leaf, subroot, (select h from outer_nodes where n = 1) as root, list_concat(down.path, up.path) as path,
         list_reduce(list_concat([claim], list_concat(down.path, up.path)), lambda c, s: case when s[1] = 'L' then sha256(s[2:] || c) else sha256(c || s[2:]) end) as folded_root
  from down join up using (g))
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) as proof_sha256, folded_root, folded_root = root as verified
from folded"""
