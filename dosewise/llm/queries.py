"""The registered queries of the operators, and DuckDB statements where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewise.llm import (
    decontaminate, infill, lines, neighbours, packing, quality, repeats, resampling, secrets, simhash, subwords, toxicity, urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(found.fingerprint).alias("fingerprint"), "component_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).drop("text_h")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    digest = F.sha2("base", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "n_markov")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_h")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut_repeats(_table(spark, sf_dir, "documents")).drop("text_h", "kept")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    rated = quality.rate(docs, model).drop("text_h")
    return rated.withColumn("selected", (F.col("tail_probability") >= quality.TAIL).cast("int"))


# The rules, and the small labelled table.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]
LABELLED_URLS = [
    *[(url, 1) for url in (
        "http://grand-casino.example.com/en/12", "https://www.casino-royal.example.net/play", "http://big-win.example.org/fr/8",
        "https://freebet-club.example.com/en/55", "http://m.sport-bets.example.net/de/31", "https://bets-online.example.org/es/7/",
        "http://cheap-meds.example.com/de/66", "https://www.pills-shop.example.net/en/4.html", "http://blog.diet-pills.example.org/fr/2",
        "http://spam-hub.example.com/en/91", "https://link-farm.example.net/es/17", "http://m.spam-mail.example.org/de/5",
        "http://ads-click.example.com/en/3", "https://www.ads-server.example.net/fr/20/", "http://track-click.example.org/en/44",
        "http://adult-zone.example.com/en/6", "https://m.adult-chat.example.net/es/11", "http://blog.x-adult.example.org/fr/73",
    )],
    *[(url, 0) for url in (
        "http://news.example.com/en/12", "https://www.city-library.example.net/en/55", "http://blog.travel.example.org/fr/8",
        "https://recipes.example.com/en/66", "http://m.weather.example.net/de/31", "https://the-museum.example.org/es/7/",
        "http://science.example.com/de/4", "https://www.school.example.net/en/91.html", "http://blog.garden.example.org/fr/2",
        "http://theatre.example.com/en/17", "https://thunder.example.net/es/3", "http://m.earth-month.example.org/de/5",
        "http://nations.example.com/en/20", "https://www.thrift.example.net/fr/44/", "http://history.example.org/en/6",
        "http://music-room.example.com/en/11", "https://m.books.example.net/es/73", "http://blog.north-path.example.org/fr/1",
    )],
]

_LABELLED_SQL = ", ".join(f"('{url}', {block})" for url, block in LABELLED_URLS)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(spark.sql(f"select * from values {_LABELLED_SQL} as v(url, block)"))
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels"))).drop("text_h")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = subwords.decoded(subwords.encoded(_table(spark, sf_dir, "documents"), packed=True))
    return made.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_secret_scans": op4_secret_scans,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_url_filters": op9_url_filters,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_importance_resampling": op13_importance_resampling,
}

# Every string of the length, in hexadecimal, and the first document that has it.
OP6_SQL = f"""
with doc as (
    select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), spot as (
    select doc_id, unnest(list_transform(range(0, length(h) // 2 - {repeats.SPAN - 1}),
        lambda i: struct_pack(place := i, body := substr(h, 2 * i + 1, {2 * repeats.SPAN}))), recursive := true) from doc
), hit as (
    select doc_id, place from spot join (select body, min(doc_id) as first_doc from spot group by body) using (body) where first_doc < doc_id
), island as (
    select doc_id, place, sum(step) over (partition by doc_id order by place) as island
    from (select doc_id, place, case when place - lag(place) over (partition by doc_id order by place) <= {repeats.SPAN} then 0 else 1 end as step from hit)
), span as (
    select doc_id, min(place) as low, max(place) + {repeats.SPAN} as high from island group by doc_id, island
), piece as (
    select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as from_at from span
), cut as (
    select doc_id, count(*) as n_spans, sum(high - low) as n_removed, max(high) as last,
        string_agg(substr(h, 2 * from_at + 1, 2 * (low - from_at)), '' order by low) as head
    from piece join doc using (doc_id) group by doc_id
)
select doc.doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
    coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) as kept_sha256
from doc left join cut using (doc_id)
"""

# Every run of at most 25 lines with just enough characters, as text, and its first place.
OP7_SQL = f"""
with doc as (
    select doc_id, text, string_split(text, chr(10)) as ls from documents
), run as (
    select doc_id, s, m, list_aggregate(list_transform(ls[s:s + m - 1], lambda x: length(x) + 1), 'sum') as size,
        length(ls[s]) + 1 as head, length(ls[s + m - 1]) + 1 as tail, array_to_string(ls[s:s + m - 1], chr(10)) as body
    from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as s from doc), range(1, {lines.MIN_CHARS} + 1) as sizes(m)
    where s + m - 1 <= len(ls)
), placed as (
    select *, first_value(doc_id) over w as first_doc, first_value(s) over w as first_s
    from run where size >= {lines.MIN_CHARS} and (size - head < {lines.MIN_CHARS} or size - tail < {lines.MIN_CHARS})
    window w as (partition by body, m order by doc_id, s)
), gone as (
    select doc_id, list(distinct line) as lines
    from (
        select doc_id, unnest(range(s, s + m)) as line from placed where first_doc < doc_id or first_doc = doc_id and first_s < s
    ) group by doc_id
)
select doc.doc_id, case when gone.lines is null then text else
    array_to_string(list_filter(ls, lambda x, i: not list_contains(gone.lines, i)), chr(10)) end as text
from doc left join gone using (doc_id)
where gone.lines is null or len(gone.lines) < len(ls)
"""

_HOST_SQL = "regexp_extract(rest, '^[^/?#]*')"
_REST_SQL = "case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end"


def _grams_sql(text: str, kind: int) -> str:
    value = str(kind)
    for n in range(urls.GRAM):
        value = f"(({value}) * {urls.BASE} + unicode(substr({text}, i::int + {n}, 1))) % {urls.BINS}"
    return f"list_transform(range(1, length({text}) - {urls.GRAM - 2}), lambda i: {value})"


_GRAMS_SQL = f"list_concat({_grams_sql("('^' || host || '$')", 1)}, {_grams_sql('path', 2)})"
_FITS_SQL = "(host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)"
_RULES_SQL = ", ".join(
    f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in URL_RULES
)

OP9_SQL = f"""
with recursive sample as (
    select row_number() over (order by url, block) as id, block::double as y, {_GRAMS_SQL} as grams
    from (
        select url, block, translate({_HOST_SQL}, '{urls.UPPER}', '{urls.LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from (select url, block, {_REST_SQL} as rest from (values {_LABELLED_SQL}) as v(url, block))
    )
), vector as (
    select id, bin, count(*) / sqrt(any_value(n)::double) as x
    from (select id, len(grams) as n, unnest(grams) as bin from sample) group by id, bin
), product as (
    select a.id, b.id as other, (select coalesce(sum(v.x * w.x), 0) from vector v join vector w using (bin) where v.id = a.id and w.id = b.id) + 1 as k
    from sample a, sample b
), problem as (
    select list(y order by id) as ys, list(ks order by id) as kss
    from (select sample.id, any_value(y) as y, list(k order by other) as ks from sample join product using (id) group by sample.id)
), descent as (
    select 0 as step, list_transform(ys, lambda y: 0::double) as alphas from problem
    union all
    select step + 1, list_transform(range(1, len(ys) + 1), lambda s:
        alphas[s] * (1 - {urls.RATE} * {urls.DECAY}) + {urls.RATE} * (ys[s] - 1 / (1 + exp(-list_sum(
            list_transform(range(1, len(ys) + 1), lambda t: alphas[t] * kss[s][t]))))))
    from descent, problem where step < {urls.STEPS}
), alpha as (
    select unnest(range(1, len(alphas) + 1)) as id, unnest(alphas) as a from descent where step = {urls.STEPS}
), weight as (
    select bin, sum(a * x) as w from vector join alpha using (id) group by bin
), page as (
    select page_id, row_number() over () as row, translate({_HOST_SQL}, '{urls.UPPER}', '{urls.LOWER}') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from (select page_id, {_REST_SQL} as rest from pages)
), scored as (
    select row, sum(coalesce(w, 0)) / sqrt(any_value(n)::double) + (select sum(a) from alpha) as eta
    from (select row, len(grams) as n, unnest(grams) as bin from (select row, {_GRAMS_SQL} as grams from page)) left join weight using (bin)
    group by row
), fit as (
    select row, arg_max(verdict, length(rule)) as verdict, arg_max(rule, length(rule)) as rule
    from page join (values {_RULES_SQL}) as r(verdict, rule, r_host, r_path) on {_FITS_SQL} group by row
)
select page_id, host, path, rule,
    coalesce(verdict, case when coalesce(eta, (select sum(a) from alpha)) >= 0 then 'block' else 'allow' end) as verdict
from page left join fit using (row) left join scored using (row)
"""

OP11_SQL = """
with doc as (
    select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h from documents
), drawn as (
    select *, length(text) as n, ('0x' || substr(h, 1, 8))::bigint % (length(text) + 1) as one,
        ('0x' || substr(h, 9, 8))::bigint % (length(text) + 1) as other,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
            or ('0x' || substr(h, 17, 8))::bigint % 100 >= 90 then 'plain'
            when ('0x' || substr(h, 25, 8))::bigint % 100 < 20 then 'spm' else 'psm' end as form
    from doc
), cut as (
    select *, substr(text, 1, least(one, other)) as prefix, substr(text, least(one, other) + 1, abs(one - other)) as middle,
        substr(text, greatest(one, other) + 1) as suffix from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
from cut
"""

# The checksum of a word from its bytes in hexadecimal, by the table of its polynomial.
OP13_SQL = f"""
with polynomial as (
    select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as steps
), given as (
    select 0 as side, doc_id, row_number() over () as row, text from documents union all select 1, null, row_number() over (), text from benchmark
), split as (
    select side, doc_id, row, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from given
), word as (
    select side, row, unnest(words) as word from split
), bucket as (
    select word, xor(4294967295, list_reduce(
        list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
        lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint)) % {resampling.BINS} as bucket
    from (select word, hex(encode(word)) as h from (select distinct word from word)), polynomial
), tally as (
    select bucket, (count(*) filter (side = 0))::double as s, (count(*) filter (side = 1))::double as t
    from word join bucket using (word) group by bucket
), total as (
    select (count(*) filter (side = 0))::double as s_all, (count(*) filter (side = 1))::double as t_all from word
), gain as (
    select bucket, floor(1000 * ln((t + 1) * (s_all + {resampling.BINS}) / ((s + 1) * (t_all + {resampling.BINS}))))::bigint as gain from tally, total
), weighed as (
    select row, sum(gain) as weight from word join bucket using (word) join gain using (bucket) where side = 0 group by row
), scored as (
    select doc_id, row, len(words) as n, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
    from split left join weighed using (row) where side = 0
), placed as (
    select row, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n_fit
    from scored where n >= {resampling.LEAST_WORDS}
)
select doc_id, n::bigint as n_features, weight::bigint as weight, score::bigint as score,
    case when rank <= {resampling.PERCENT} * n_fit // 100 then rank end as rank
from scored left join placed using (row)
"""

ORACLES: dict[str, str] = {
    "op9_url_filters": OP9_SQL,
    "op6_suffix_array_dedup": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}
