"""One named query per operator over its whole table, and SQL with the same result where SQL can
express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (
    decontaminate,
    embeddings,
    html,
    mixing,
    pieces,
    pii,
    quality,
    search,
    secrets,
    simhash,
    spelling,
    toxicity,
    urls,
)
from salesflow.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PII_KEY = "example key: a job passes its own"
TARGETS = {"clean": 0.9, "junk": 0.08, "toxic": 0.02}


def label_domain():
    """Domain of a row of ``labels``."""
    return F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")


def held_out(id_col: str = "doc_id"):
    """The third of the documents whose labels are for testing only."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


@query
def op1_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op2_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op2_rotation_codes"] = """
with recursive vectors as (
    select vec_id, label, cast(embedding as double[]) as v from embeddings
    where label is not null and len(list_filter(embedding, lambda x: x <> 0)) > 0
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(id, other) as (
    select vec_id, vec_id from embeddings
    union select reach.id, links.b from reach join links on reach.other = links.a
),
components as (select id, min(other) as component_id from reach group by id)
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept
from embeddings join components on id = vec_id
"""


@query
def op3_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    shares = ("score", "similarity", "question_overlap", "answer_overlap")
    return found.withColumns({c: F.round(c, 6) for c in shares})


# All passages against all items, without an index.
ORACLES["op3_bm25_decontamination"] = r"""
with words as (
    select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from benchmark
),
items as (
    select item_id, w, len(w) as n,
        case when len(w) < 10 then w else w[:len(w) - greatest(5, len(w) // 4)] end as q,
        case when len(w) < 10 then w else w[len(w) - greatest(5, len(w) // 4) + 1:] end as a
    from words
),
runs as (
    select *, list_distinct(list_concat(
        list_transform(range(1, greatest(len(q) - 5, 0) + 2), lambda i: array_to_string(q[i:i + 4], ' ')),
        list_transform(range(1, greatest(len(a) - 5, 0) + 2), lambda i: array_to_string(a[i:i + 4], ' ')))) as shingles
    from items
),
size as (select count(*) as items, avg(n) as mean, cast(ceil(1.25 * max(n)) as int) as stride from items),
tf as (select item_id, n, term, count(*) as f from (select item_id, n, unnest(w) as term from items) group by all),
df as (select term, count(*) as d from tf group by term),
weights as (
    select item_id, term,
        ln(1 + (items - d + 0.5) / (d + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / mean)) as weight
    from tf join df using (term), size
),
impacts as (select item_id, term, weight / sum(weight) over (partition by item_id) as share from weights),
docs as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents),
chunks as (select doc_id, w, stride, unnest(range(0, cast(ceil(len(w) / stride) as int))) as passage from docs, size),
passages as (select doc_id, cast(passage as int) as passage, w[passage * stride + 1:(passage + 2) * stride] as run from chunks),
terms as (select distinct doc_id, passage, unnest(run) as term from passages),
scores as (
    select doc_id, passage, item_id, sum(share) as score from terms join impacts using (term)
    group by all having sum(share) >= 0.5
),
shares as (
    select doc_id, passage, item_id, score,
        len(list_filter(shingles, lambda s: contains(' ' || array_to_string(run, ' ') || ' ', ' ' || s || ' ')))
            / len(shingles) as similarity,
        len(list_intersect(list_distinct(q), run)) / len(list_distinct(q)) as question_overlap,
        len(list_intersect(list_distinct(a), run)) / len(list_distinct(a)) as answer_overlap
    from scores join passages using (doc_id, passage) join runs using (item_id)
)
select doc_id, item_id, passage, round(score, 6) as score, round(similarity, 6) as similarity,
    round(question_overlap, 6) as question_overlap, round(answer_overlap, 6) as answer_overlap
from shares where similarity >= 0.8 and question_overlap >= 0.8 and answer_overlap >= 0.8
qualify row_number() over (
    partition by doc_id, item_id order by similarity desc, round(score, 9) desc, passage) = 1
"""


# fixed values: the rules of the contract
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query
def op4_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op4_url_digests"] = f"""
with rules(rule_host, rule_path, rule_verdict) as (values {", ".join(str(r) for r in URL_RULES)}),
split as (
    select page_id,
        case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
),
parts as (
    select page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from split
),
fits as (
    select page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
        arg_max(rule_verdict, length(rule_host || rule_path)) as rule_verdict
    from parts left join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by all
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from fits
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op6_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    findings, base = F.col("findings"), [r.kind for r in secrets.BASE_RULES]
    return found.select(
        "doc_id",
        *[secrets.count_of(findings, kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.digest(findings, base), 256).alias("base_sha256"),
        secrets.digest(findings).alias("spans"),
    )


def _spans_sql() -> str:
    """Per document the list of (start, order of the kind, end) over all rules, in DuckDB. The text
    is split at a rule's matches; the lengths before a match add up to its start."""
    lists = []
    for i, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''").replace("(?<![A-Za-z0-9_-])", "")
        checked = f"regexp_extract_all(t, '{pattern}', {rule.group})"
        lists.append(f"""list_filter(list_transform(
            range(1, len(regexp_extract_all(t, '{pattern}')) + 1),
            lambda k: struct_pack(
                s := coalesce(list_sum(list_transform(string_split_regex(t, '{pattern}')[1:k], lambda x: length(x))), 0)
                    + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:k-1], lambda x: length(x))), 0),
                o := {i},
                e := length(regexp_extract_all(t, '{pattern}')[k]),
                ok := length({checked}[k]) >= {rule.min_length})),
            lambda f: f.ok)""")
    return "list_sort(list_concat(" + ", ".join(lists) + "))"


_KINDS_SQL = "[" + ", ".join(f"'{r.kind}'" for r in secrets.RULES) + "]"
_JOINED_SQL = f"lambda f: {_KINDS_SQL}[f.o + 1] || ':' || cast(f.s as bigint) || ':' || cast(f.s + f.e as bigint)"
ORACLES["op6_blob_ledger"] = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
spans as (select doc_id, {_spans_sql()} as found from texts)
select doc_id,
    len(list_filter(found, lambda f: f.o = 0)) as n_assign,
    len(list_filter(found, lambda f: f.o = 1)) as n_access,
    len(list_filter(found, lambda f: f.o = 2)) as n_hex,
    sha256(array_to_string(list_transform(list_filter(found, lambda f: f.o < 3), {_JOINED_SQL}), ',')) as base_sha256,
    array_to_string(list_transform(found, {_JOINED_SQL}), ',') as spans
from spans
"""


@query
def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = toxicity.score_documents(docs, toxicity.fit(labels, docs), threshold=0.7)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op8_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html.extract_text(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", "n_chars")


# For pages as those of the table, which mark their article and know few character references.
ORACLES["op8_site_templates"] = r"""
with inner_html as (
    select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|<footer|$)', 1) as body from pages
),
plain as (
    select page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        body, '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g') as text
    from inner_html
)
select page_id, url, trim(text) as text, length(trim(text)) as n_chars from plain
"""


@query
def op9_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    # texts are read once: the model is fitted on their features and scores them
    docs = stage(quality.encode(docs).select("doc_id", "features"), "features")
    model = quality.fit(labels, docs, features_col="features")
    scored = quality.score_documents(docs, model, features_col="features")
    return scored.select("doc_id", "p_content", "p_layout", "score", "kept")


@query
def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels, label_domain(), TARGETS)


@query
def op11_range_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# All documents against all items.
ORACLES["op11_range_maxima"] = r"""
with doc_words as (
    select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') as words
    from documents
),
item_terms as (
    select row, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+'))) as term
    from (select row_number() over () as row, * from benchmark)
),
size as (
    select count(*) filter (len(words) > 0) as n_docs, cast(sum(len(words)) as bigint) as n_words from doc_words
),
tf as (
    select row, term, count(*) as tf from (select row, unnest(words) as term from doc_words) group by all
),
weights as (
    select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from tf, size group by term, n_docs
),
lengths as (
    select row, doc_id, 100 - 50 + (50 * len(words) * n_docs) // n_words as m from doc_words, size where len(words) > 0
),
impacts as (
    select row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) as impact
    from tf join weights using (term) join lengths using (row)
),
scores as (
    select i.row, item_id, d.row as doc_row, doc_id, cast(sum(impact) as bigint) as score
    from item_terms i join impacts d using (term) group by all having sum(impact) > 0
)
select item_id, cast(row_number() over (partition by row order by score desc, doc_id, doc_row) as int) as rank, doc_id, score
from scores qualify rank <= 50
"""


SLIP_EVERY, MIN_LETTERS, MIN_COUNT = 97, 5, 3  # fixed values: the words of the contract


@query
def op12_q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs_of_letters(table(spark, sf_dir, "documents"), MIN_LETTERS)
    words = runs.select(spelling.slip(F.col("run"), F.col("doc"), SLIP_EVERY).alias("word"))
    return spelling.variants(spelling.count_words(words, MIN_LETTERS, MIN_COUNT))


def _crc_table() -> list[int]:
    """CRC-32 of the 256 bytes, by the reflected polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [(c >> 1) ^ (0xEDB88320 * (c & 1)) for c in table]
    return table


# Words are near if they are equal without the character at one place: of both, or of the longer one.
ORACLES["op12_q_chunks"] = f"""
with recursive runs as (
    select coalesce(cast(doc_id as varchar), '') as doc, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as run
    from documents
),
lower_runs as (
    select doc, run, hex(encode(doc || ':' || run)) as h, count(*) as n
    from (select doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from runs)
    where length(run) >= 5 group by all
),
bytes as (
    select run, n, list_transform(range(0, length(h) // 2), lambda i:
        16 * (strpos('0123456789ABCDEF', substr(h, cast(2 * i + 1 as int), 1)) - 1)
        + strpos('0123456789ABCDEF', substr(h, cast(2 * i + 2 as int), 1)) - 1) as b
    from lower_runs
),
hashed as (
    select run, n, xor(list_reduce(list_concat([4294967295::bigint], b), lambda c, x:
        xor(c >> 8, ({_crc_table()}::bigint[])[1 + (xor(c, x) & 255)])), 4294967295) as h
    from bytes
),
slipped as (
    select n, case when h % 97 = 0
        then substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word
    from hashed
),
words as (
    select word, cast(sum(n) as bigint) as n from slipped where length(word) >= 5 group by word having sum(n) >= 3
),
without as (
    select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest
    from (select word, n, unnest(range(0, length(word))) as i from words)
),
edits as (
    select a.word, a.n, b.word as near, b.n as near_n from without a join without b using (i, rest) where a.word <> b.word
    union select a.word, a.n, b.word, b.n from words a join without b on a.word = b.rest
    union select b.word, b.n, a.word, a.n from words a join without b on a.word = b.rest
),
best as (
    select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n
    from edits group by word
),
forms as (
    select words.word, words.n, coalesce(n_near, 0) as n_near,
        case when near_n >= 2 * words.n then near end as form, case when near_n >= 2 * words.n then near_n end as form_n
    from words left join best using (word)
),
steps(word, reached, form) as (
    select word, word, form from forms
    union all select steps.word, forms.word, forms.form from steps join forms on steps.form = forms.word
)
select word, forms.form, reached as root, n, n_near, form_n from forms join steps using (word) where steps.form is null
"""


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = pieces.load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, tokenizer, ("n_tokens", "packed", "decoded"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
