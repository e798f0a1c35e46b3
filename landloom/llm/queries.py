"""One query per operator over its whole table, and SQL twins where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[^\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; every executor has it at the same place."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    from . import sentencepiece as codec
    path = tokenizer_file("piece_bpe_32k.model")
    done = codec.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    ids = F.sha2(F.array_join("ids", ",").cast("binary"), 256)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(codec.BLANK), F.lit(" "))).alias("round_trip"))


@query("op2_minhash_near_dedup", f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{BLANKS}') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
   AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(node, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.node),
m AS (SELECT node, min(c) AS c FROM r GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id, m.c = s.doc_id AS kept
FROM s JOIN m ON m.node = s.doc_id""")
def op2(spark, sf_dir):
    from .minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


OVER_LIMIT = 2048


@query("op3_token_counts")
def op3(spark, sf_dir):
    from .token_counts import count_tokens
    out = count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


@query("op4_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 400) AS g
      FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 199, 0))) AS i FROM d)),
r AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
m AS (SELECT doc_id, i FROM s SEMI JOIN r USING (g)),
b AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, TRUE) AS new FROM m),
n AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b),
p AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM n GROUP BY doc_id, k),
q AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM p),
k AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, max(z) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS x
      FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(x, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op4(spark, sf_dir):
    from .suffix import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op5_lm_scoring")
def op5(spark, sf_dir):
    from .ppm import pretrained
    return pretrained(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def op6(spark, sf_dir):
    from . import ranker
    from .minhash import stored
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = ranker.held_out(F.col("doc_id"))
    rows = stored(ranker.measured(docs), "ranker-vectors")  # every text is looked at once
    model = ranker.fit_vectors(rows, labels.filter(~held).select("doc_id", F.col("quality").alias("label")))
    return ranker.score_vectors(rows, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op7_quality_rules")
def op7(spark, sf_dir):
    from .quality_rules import quality_rules
    labels = table(spark, sf_dir, "labels")
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), labels.filter("quality = 1"))
    return out.drop("text")


OWN_TURNS = "</s>[INST] ok [/INST]"
_ESCAPED = "replace(replace(replace(replace({}, '\\', '\\e'), '<', '\\l'), '[', '\\b'), ']', '\\r')"


@query("op8_chat_formatting", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{OWN_TURNS}' UNION ALL SELECT -1, 1, 'assistant', '{OWN_TURNS}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(11 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""")
def op8(spark, sf_dir):
    from . import chat
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    # one more conversation, of control strings
    turn = F.col("id")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), turn.alias("turn"),
                                F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit(OWN_TURNS).alias("text"))
    rows = talks.union(own).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    out = chat.format_chat(rows).withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))})
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), chat.turn_digest(F.col("turns")).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


_ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query("op9_benchmark_decontamination", f"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{_ITEM}') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
         lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM b WHERE len(w) > 0),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{_ITEM}') AS w FROM documents),
k AS (SELECT DISTINCT width FROM g),
s AS (
  SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS i, unnest(list_transform(range(1, len(w) - width + 2),
         lambda i: array_to_string(w[i:i + width - 1], ' '))) AS g FROM d, k WHERE len(w) >= width),
m AS (SELECT doc_id, s.i, s.width, item_id FROM s JOIN g USING (width, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS x
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.x, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op9(spark, sf_dir):
    from .decontaminate import decontaminate
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
_CASES = " ".join(f"WHEN {_FITS.format(h=h, p=p)} THEN '{v}'" for v, h, p in sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")))
_NAMES = " ".join(f"WHEN {_FITS.format(h=h, p=p)} THEN '{h + p}'" for v, h, p in sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")))


@query("op10_url_filters", f"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{SMALL}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
c AS (SELECT *, CASE WHEN host = '' THEN '' ELSE regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(www|m)\\.', '')
         || regexp_replace(path, '/+$', '') END AS address FROM p),
l AS (SELECT address FROM c WHERE address <> '' GROUP BY address HAVING count(*) > 1),
j AS (SELECT *, CASE {_NAMES} END AS rule, CASE {_CASES} END AS v FROM c)
SELECT page_id, host, path, rule,
  coalesce(v, CASE WHEN address IN (SELECT address FROM l) THEN 'block' ELSE 'allow' END) AS verdict FROM j""")
def op10(spark, sf_dir):
    from . import urls
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # the list: addresses that several pages share once scheme, query, www and closing slashes are gone
    address = urls.canonical(urls.host_of(F.col("url")), urls.path_of(F.col("url")))
    listed = (pages.groupBy(address.alias("address")).agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url"))
              .filter("n > 1 and address <> ''").select("url"))
    return urls.judge_urls(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


END_ID = 1


@query("op11_token_records")
def op11(spark, sf_dir):
    import uuid
    from landloom.session import checkpoint_dir
    from . import token_records
    path = f"{checkpoint_dir(spark).rstrip('/')}/token-records-{uuid.uuid4().hex}"
    token_records.write_records(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path, END_ID)
    out = token_records.read_records(spark, path, "doc_id long, start long, n_tokens long, data binary")
    return out.select("doc_id", "start", "n_tokens", F.crc32("data").alias("ids_crc32"))


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@query("op12_source_divergence", f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '{_TERM}') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
x AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // (sum(total) OVER w + 5 * count(*) OVER w) AS q
  FROM x WINDOW w AS (PARTITION BY lang, source)),
v AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
WHERE part = 'pair' OR rank <= 50""")
def op12(spark, sf_dir):
    from .source_audit import source_divergence
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op13_tokenizer_alignment")
def op13(spark, sf_dir):
    from . import alignment
    from .minhash import stored
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    laid = alignment.align(table(spark, sf_dir, "documents"), *files)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    laid = stored(laid.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), "aligned")
    scores = alignment.link_scores(laid, alignment.pair_counts(laid))
    return laid.drop("pairs", "times").join(scores, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
