"""The same results as the named queries, stated in DuckDB SQL."""

from __future__ import annotations

from quillstream.functions.text import STOP_WORDS

_STOPS = ", ".join("'" + word.replace("'", "''") + "'" for word in ("", *STOP_WORDS))


def _sub(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def _kept(words: str) -> str:
    return f"list_filter({words}, lambda w: w NOT IN ({_STOPS}))"


def _joined(words: str) -> str:
    return f"coalesce(array_to_string({words}, ' '), '')"


def _tokens(text: str) -> str:
    text = _sub(text, r"http\S+")
    text = _sub(text, r"[a-z0-9.\-+_]+@[a-z0-9.\-+_]+\.[a-z]+")
    text = f"lower({_sub(text, '[^a-zA-Z0-9]+', ' ')})"
    return _kept(f"string_split({_sub(text, '[0-9]+', '[num]')}, ' ')")


def _eda_tokens(text: str) -> str:
    text = _sub(_sub(text, "@[A-Za-z0-9_]+"), "#[A-Za-z0-9_]+")
    return _kept(f"string_split({_sub(text, '[^a-z]+', ' ')}, ' ')")


def _no_hashtag(text: str) -> str:
    return _sub(text, "#[A-Za-z0-9_]+")


CLEAN = _joined(_tokens("tweet"))
CLEAN_WO = _joined(_tokens(_no_hashtag("tweet")))
EDA = _joined(_eda_tokens("tweet"))
TAGS = "regexp_extract_all({}, '#([a-zA-Z0-9_]{{1,50}})', 1)"
BUCKET = "('0x' || substr(md5(id), 1, 8))::BIGINT"

_TWEETS = """tweets AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         concat(text, ' #', source, ' #', lang, ' @user', CAST(doc_id % 10 AS VARCHAR),
                ' http://t.co/', CAST(doc_id AS VARCHAR), ' &amp;') AS tweet,
         strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000),
                  '%Y-%m-%dT%H:%M:%S.000Z') AS created_at,
         make_timestamp((1704067200 + doc_id * 60) * 1000000) AS ts,
         lang, source
  FROM documents)"""
_LABELED = """labeled AS (
  SELECT t.id, t.tweet, l.toxic AS label
  FROM tweets t JOIN labels l ON t.id = CAST(l.doc_id AS VARCHAR))"""
_LABELED_DOCS = """labeled_docs AS (
  SELECT d.doc_id, d.text, l.toxic AS label FROM documents d LEFT JOIN labels l USING (doc_id))"""
_SCORED = f"""chances AS (
  SELECT *, CAST({BUCKET} AS DOUBLE) / CAST(4294967295 AS DOUBLE) AS p FROM tweets),
results AS (
  SELECT id, tweet AS raw_tweet, {CLEAN} AS tweet, {CLEAN_WO} AS tweet_wo_hashtag,
         created_at AS time_stamp, ts,
         CASE WHEN p > 0.5 THEN 'hate' ELSE 'not_hate' END AS prediction,
         CAST(CASE WHEN p > 0.5 THEN p ELSE CAST(1 AS DOUBLE) - p END AS FLOAT) AS confidence_score
  FROM chances),
words AS (
  SELECT id, ts, prediction, unnest(string_split(tweet_wo_hashtag, ' ')) AS word FROM results
  WHERE tweet_wo_hashtag <> '')"""

_FAILED = "CAST(confidence_score AS DOUBLE) < CAST(0.7 AS DOUBLE)"
_DAY_KEY = ("CAST(year(ts) AS VARCHAR) || CAST(month(ts) AS VARCHAR) || CAST(day(ts) AS VARCHAR)")

_VIEWS = {"tweets": _TWEETS, "labeled": _LABELED, "labeled_docs": _LABELED_DOCS, "results": _SCORED}
_NEEDS = {"tweets": ["tweets"], "labeled": ["tweets", "labeled"],
          "labeled_docs": ["labeled_docs"], "results": ["tweets", "results"]}


def _over(view: str, body: str, *more: str) -> str:
    """``body`` with the named view (and further common tables) in front."""
    return "WITH " + ",\n".join([*(_VIEWS[v] for v in _NEEDS[view]), *more]) + "\n" + body


_COUNTS = """counts AS (
  SELECT toxic AS label, quality AS prediction, count(*) AS n FROM labels GROUP BY 1, 2)"""
_BY_CLASS = _COUNTS + """,
classes AS (SELECT label AS class FROM counts UNION SELECT prediction FROM counts),
sides AS (
  SELECT class,
         coalesce((SELECT sum(n) FROM counts WHERE label = class), 0) AS n_true,
         coalesce((SELECT sum(n) FROM counts WHERE prediction = class), 0) AS n_predicted,
         coalesce((SELECT sum(n) FROM counts WHERE label = class AND prediction = class), 0) AS n_hit
  FROM classes),
rates AS (
  SELECT class, n_true,
         CASE WHEN n_predicted > 0 THEN n_hit::DOUBLE / n_predicted ELSE 0 END AS precision,
         CASE WHEN n_true > 0 THEN n_hit::DOUBLE / n_true ELSE 0 END AS recall
  FROM sides),
by_class AS (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM rates)"""


def _describe(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max "
        f"FROM {table}" for c in columns
    )


def _top(words: str, name: str, k: int) -> str:
    return (f"SELECT {name}, count(*) AS frequency FROM ({words}) GROUP BY {name} "
            f"ORDER BY frequency DESC, {name} LIMIT {k}")


def _class_words(value: int) -> str:
    words = f"SELECT unnest({_eda_tokens('tweet')}) AS word FROM labeled WHERE label = {value}"
    return f"SELECT {value} AS label, * FROM ({_top(words, 'word', 20)})"


def _class_tags(value: int, condition: str) -> str:
    tags = (f"SELECT unnest({TAGS.format('tweet')}) AS hashtag FROM labeled "
            f"WHERE label = {value} AND {condition}")
    return f"SELECT {value} AS label, * FROM ({_top(tags, 'hashtag', 5)})"


_TERMS = f"""terms AS (SELECT id, unnest({_tokens('tweet')}) AS word FROM tweets),
idf AS (
  SELECT word, count(DISTINCT id) AS doc_freq,
         ln(((SELECT count(*) FROM tweets) + 1.0)::DOUBLE / (count(DISTINCT id) + 1.0)::DOUBLE) AS idf
  FROM terms GROUP BY word)"""

# Murmur3 (32 bits, seed 42) of every word, as fixed by its published constants.  Words are ASCII
# here, so their length is that of their bytes.  ``_BLOCK`` reads four bytes, lowest first.
_MOD = "4294967296::HUGEINT"
_BLOCK = ("('0x' || substr(h, {0} + 6, 2) || substr(h, {0} + 4, 2) || substr(h, {0} + 2, 2) "
          "|| substr(h, {0}, 2))::BIGINT::HUGEINT")


def _scrambled(block: str) -> str:
    """A list with the scrambled ``block`` expressions of the list ``block``."""
    first = f"list_transform({block}, lambda b: b * 3432918353 % {_MOD})"
    return (f"list_transform({first}, lambda k: "
            f"(k * 32768 % {_MOD} + k // 131072) * 461845907 % {_MOD})")


_BUCKETS = f"""doc_words AS (SELECT id, unnest(string_split({CLEAN}, ' ')) AS word FROM tweets),
word_bytes AS (
  SELECT DISTINCT word, length(word) AS n, hex(encode(word)) || '000000' AS h FROM doc_words),
word_blocks AS (
  SELECT word, n,
         {_scrambled(f"list_transform(range(n // 4), lambda i: {_BLOCK.format('(8 * i + 1)')})")} AS whole,
         {_scrambled(f"[CASE WHEN n % 4 = 0 THEN 0::HUGEINT ELSE {_BLOCK.format('(8 * (n // 4) + 1)')} END]")}[1]
           AS rest
  FROM word_bytes),
folded AS (
  SELECT word, xor(xor(list_reduce(list_prepend(42::HUGEINT, whole), lambda a, k:
           ((xor(a, k) * 8192 % {_MOD} + xor(a, k) // 524288) * 5 + 3864292196) % {_MOD}),
           rest), n::HUGEINT) AS h
  FROM word_blocks),
mixed_1 AS (SELECT word, xor(h, h // 65536) * 2246822507 % {_MOD} AS h FROM folded),
mixed_2 AS (SELECT word, xor(h, h // 8192) * 3266489909 % {_MOD} AS h FROM mixed_1),
buckets AS (SELECT word, (xor(h, h // 65536) % 262144)::INTEGER AS bucket FROM mixed_2),
bucket_counts AS (
  SELECT id, bucket, count(*) AS tf FROM doc_words JOIN buckets USING (word) GROUP BY 1, 2)"""

_FIT_FACTS = f"""
  SELECT coalesce(CAST(label AS VARCHAR), 'all') AS class, count(*) AS n_true, {{}} AS n_fitted,
         0::DOUBLE AS slope, {{}}
  FROM labeled WHERE {BUCKET} % 10 >= 8 GROUP BY ROLLUP (label)"""

# The settings of the chosen and of the baseline fit.
_SETTINGS = {
    "chosen": "0.1::DOUBLE AS reg_param, 0.015::DOUBLE AS elastic_net, 'binomial' AS family, 'weight' AS weight_col",
    "baseline": "1.0::DOUBLE AS reg_param, 0.0::DOUBLE AS elastic_net, 'auto' AS family, 'no_weight' AS weight_col",
}

ORACLE: dict[str, str] = {
    "scan_csv": _over("labeled", r"""SELECT id, regexp_replace(tweet, '[\r\n]+', ' ', 'g') AS tweet,
        label FROM labeled"""),
    "stream_ingest": _over("tweets", "SELECT id, tweet, created_at AS time_stamp FROM tweets"),
    "parse_json": _over("tweets", """
        SELECT CASE WHEN ok THEN id END AS id, CASE WHEN ok THEN tweet END AS text,
               CASE WHEN ok THEN source END AS source, CASE WHEN ok THEN created_at END AS created_at,
               CAST(NOT ok AS INTEGER) AS is_bad
        FROM (SELECT *, CAST(id AS BIGINT) % 7 <> 0 AS ok FROM tweets)"""),
    "project_record": _over("tweets", "SELECT id, tweet, created_at AS time_stamp FROM tweets"),
    "to_queue_json": _over("tweets", """
        SELECT sha256(length(tweet) || ':' || tweet || length(created_at) || ':' || created_at ||
                      length(source) || ':' || source) AS id, tweet AS text, source, created_at
        FROM tweets"""),
    "sample_k": """SELECT CAST(doc_id AS VARCHAR) AS key, text FROM documents
        ORDER BY md5(CAST(doc_id AS VARCHAR)), key LIMIT 100""",
    "union_demo": """
        SELECT conv_id || '-' || turn AS id, text AS tweet FROM conversations
        UNION ALL
        SELECT sha256(length(key) || ':' || key || length(text) || ':' || text) AS id, text AS tweet FROM (
          SELECT CAST(doc_id AS VARCHAR) AS key, text FROM documents ORDER BY md5(key), key LIMIT 100)""",
    "select_recent": _over("tweets", """
        SELECT id, tweet, created_at FROM tweets, (SELECT max(ts) AS newest FROM tweets)
        WHERE ts >= newest - INTERVAL 15 MINUTE AND ts < newest
          AND lang = 'en' AND contains(lower(tweet), 'the')"""),
    "cap_recent": _over("tweets", """
        SELECT id, tweet, created_at FROM tweets ORDER BY ts DESC, id LIMIT 35"""),
    "sink_clean": _over("results", """
        SELECT id, tweet, tweet_wo_hashtag, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_stamp,
               prediction, CAST(confidence_score AS DOUBLE) AS confidence_score FROM results"""),
    "sink_words": _over("results", f"""
        SELECT {_DAY_KEY} AS time, prediction, word, count(*) AS frequency
        FROM words GROUP BY 1, 2, 3"""),
    "sink_failed": _over("results", f"""
        SELECT id, tweet, raw_tweet, prediction FROM results WHERE {_FAILED}"""),
    "word_rows": _over("results", f"SELECT word, {_DAY_KEY} AS time, prediction FROM words"),
    "shape": """
        SELECT 'train' AS table_name, count(*) AS n_rows, 3 AS n_columns
        FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT 'test', count(*), 2 FROM documents""",
    "shape_distinct": _over("labeled_docs", """
        SELECT 'train' AS table_name, count(*) AS n_rows, 3 AS n_columns
        FROM (SELECT DISTINCT text, label FROM labeled_docs WHERE label IS NOT NULL)
        UNION ALL SELECT 'test', count(DISTINCT text), 2 FROM documents"""),
    "preview": "SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 5",
    "describe": _describe("documents", "doc_id", "n_chars") + " UNION ALL "
                + _describe("labels", "quality", "toxic"),
    "dup_groups": _over("labeled_docs", """
        SELECT text, label, count(*) AS count FROM labeled_docs GROUP BY ALL HAVING count(*) > 1"""),
    "dup_groups_unlabeled": """
        SELECT text, count(*) AS count FROM documents GROUP BY text HAVING count(*) > 1""",
    "dup_total": _over("labeled_docs", """
        SELECT 'train' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT count(*) AS n FROM labeled_docs GROUP BY text, label HAVING count(*) > 1)
        UNION ALL
        SELECT 'test', CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)"""),
    "dedup": _over("labeled_docs", """
        SELECT min(doc_id) AS doc_id, text, label FROM labeled_docs GROUP BY text, label"""),
    "dedup_unlabeled": "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text",
    "drop_nulls": "SELECT d.doc_id, d.text, l.toxic AS label FROM documents d JOIN labels l USING (doc_id)",
    "class_share": """
        SELECT label, count(*) FILTER (WHERE toxic = label) AS n,
               round(100.0::DOUBLE * count(*) FILTER (WHERE toxic = label) / count(*), 6) AS percent
        FROM labels JOIN documents USING (doc_id), (VALUES (0), (1)) AS c(label) GROUP BY label""",
    "by_class": _over("labeled", "SELECT id, tweet, label FROM labeled WHERE label = 1"),
    "hashtags": _over("tweets", f"SELECT id, {_joined(TAGS.format('tweet'))} AS hashtags FROM tweets"),
    "clean_eda": _over("tweets", f"SELECT id, {EDA} AS clean_tweet FROM tweets"),
    "clean_model": _over("tweets", f"SELECT id, {CLEAN} AS tweet FROM tweets"),
    "clean_no_hashtag": _over("tweets", f"SELECT id, {CLEAN_WO} AS tweet_wo_hashtag FROM tweets"),
    "hashtag_count": f"""
        SELECT doc_id, greatest(len({TAGS.format('text')}), 1)::INTEGER AS hashtags_count,
               len({TAGS.format('text')})::INTEGER AS n_hashtags FROM documents""",
    "word_count": _over("tweets", f"""
        SELECT id, greatest(len({_eda_tokens('tweet')}), 1)::INTEGER AS tweet_word_count,
               len({_eda_tokens('tweet')})::INTEGER AS n_words FROM tweets"""),
    "unigrams": _over("tweets", f"""
        SELECT id, unnest(string_split({CLEAN}, ' ')) AS unigram FROM tweets"""),
    "vocab_size": _over("tweets", f"""
        SELECT count(*) AS total_words, count(DISTINCT u) AS distinct_words
        FROM (SELECT unnest(string_split({CLEAN}, ' ')) AS u FROM tweets)"""),
    "word_freq": _over("labeled", f"""
        SELECT label, word, count(*) AS frequency
        FROM (SELECT label, unnest({_eda_tokens('tweet')}) AS word FROM labeled) GROUP BY 1, 2"""),
    "hashtag_freq": _over("labeled", f"""
        SELECT label, hashtag, count(*) AS frequency
        FROM (SELECT label, unnest({TAGS.format('tweet')}) AS hashtag FROM labeled) GROUP BY 1, 2"""),
    "hashtag_freq_nonempty": _over("labeled", f"""
        SELECT hashtag, count(*) AS frequency
        FROM (SELECT unnest({TAGS.format('tweet')}) AS hashtag FROM labeled
              WHERE label = 1 AND {EDA} <> '') GROUP BY 1"""),
    "top_words": _over("tweets", _top(
        f"SELECT unnest({_tokens('tweet')}) AS word FROM tweets", "word", 20)),
    "top_words_by_class": _over("labeled", f"{_class_words(0)} UNION ALL {_class_words(1)}"),
    "top_hashtags_by_class": _over(
        "labeled", f"{_class_tags(0, 'true')} UNION ALL {_class_tags(1, EDA + ' <> {}')}"
        .replace("{}", "''")),
    "top_hashtags": _over("tweets", _top(
        f"SELECT unnest({TAGS.format('tweet')}) AS hashtag FROM tweets", "hashtag", 5)),
    "contains_filter": "SELECT doc_id, text FROM documents WHERE contains(text, 'amp')",
    "parse_ts": _over("tweets", """
        SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 <> 0
                        THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
               CAST(CAST(id AS BIGINT) % 5 = 0 AS INTEGER) AS is_bad FROM tweets"""),
    "day_key": _over("tweets", f"""
        SELECT id, {_DAY_KEY} AS day_key, strftime(ts, '%Y-%m-%d') AS day FROM tweets"""),
    "make_id": _over("tweets", """
        SELECT id, sha256(length(tweet) || ':' || tweet || length(created_at) || ':' || created_at) AS key
        FROM tweets"""),
    "map_labels": """
        SELECT doc_id, CASE toxic WHEN 1 THEN 'hate' ELSE 'not_hate' END AS label,
               CASE quality WHEN 1 THEN 'hate' ELSE 'not_hate' END AS prediction FROM labels""",
    "hashing_tf": _over("tweets", """
        SELECT bucket, CAST(sum(tf) AS DOUBLE) AS tokens, count(*) AS doc_freq
        FROM bucket_counts GROUP BY bucket""", _BUCKETS),
    "features": _over("tweets", """
        SELECT bucket, count(*) AS doc_freq,
               round(sum(tf)::DOUBLE * ln(((SELECT count(*) FROM tweets) + 1.0)::DOUBLE
                                          / (count(*) + 1.0)::DOUBLE), 3) AS weight
        FROM bucket_counts GROUP BY bucket""", _BUCKETS),
    "idf_terms": _over("tweets", "SELECT word, doc_freq, round(idf, 6) AS idf FROM idf", _TERMS),
    "tfidf_terms": _over("tweets", """
        SELECT id, word, tf, round(tf * idf, 6) AS tfidf
        FROM (SELECT id, word, count(*) AS tf FROM terms GROUP BY 1, 2) JOIN idf USING (word)""",
        _TERMS),
    "class_weights": """
        SELECT CAST(doc_id AS VARCHAR) AS id, toxic AS label,
               round(CASE WHEN toxic = 1 THEN 1.0::DOUBLE - r ELSE r END, 6) AS weight,
               1.0::DOUBLE AS no_weight
        FROM labels, (SELECT avg(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS r FROM labels)""",
    "split_train": f"""
        SELECT id, label FROM (SELECT CAST(doc_id AS VARCHAR) AS id, toxic AS label FROM labels)
        WHERE {BUCKET} % 10 < 8""",
    "split_test": f"""
        SELECT id, label FROM (SELECT CAST(doc_id AS VARCHAR) AS id, toxic AS label FROM labels)
        WHERE {BUCKET} % 10 >= 8""",
    "model_roundtrip": """
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
        FROM documents JOIN labels USING (doc_id)""",
    "score_check": _over("tweets", f"SELECT id, {CLEAN} AS tweet, 0::INTEGER AS disagrees FROM tweets"),
    "format_predictions_check": _over("tweets", f"""
        SELECT id, {CLEAN} AS tweet, {CLEAN_WO} AS tweet_wo_hashtag, created_at AS time_stamp,
               0::INTEGER AS disagrees FROM tweets"""),
    "score_closed_form": _over("labeled", f"""
        SELECT id, {CLEAN} AS tweet, CASE WHEN p > 0.5 THEN 'hate' ELSE 'not_hate' END AS prediction,
               round(CAST(CAST(greatest(p, 1.0::DOUBLE - p) AS FLOAT) AS DOUBLE), 5) AS confidence
        FROM tweets, (SELECT avg(label) AS p FROM labeled WHERE {BUCKET} % 10 < 8)"""),
    "describe_text": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS min, max({c}) AS max FROM documents"
        for c in ("text", "lang", "source")),
    "train": _over("labeled", _FIT_FACTS.format(
        f"(SELECT count(*) FROM labeled WHERE {BUCKET} % 10 < 8)", _SETTINGS["chosen"])),
    "train_baseline": _over("labeled", _FIT_FACTS.format(
        f"(SELECT count(*) FROM labeled WHERE {BUCKET} % 10 < 8)",
        _SETTINGS["baseline"] + ", 1::INTEGER AS is_smaller, 0::INTEGER AS n_zero")),
    "retrain": _over("results", _FIT_FACTS.format(f"""
        (SELECT count(*) FROM results r JOIN labels l ON r.id = CAST(l.doc_id AS VARCHAR)
         WHERE {_FAILED} AND {BUCKET} % 10 < 8)""", _SETTINGS["chosen"] + ", 2::INTEGER AS version"), _LABELED),
    "eval_overall": "WITH " + _BY_CLASS + """
        SELECT round(sum(f1 * n_true) / sum(n_true), 6) AS f1,
               round(sum(precision * n_true) / sum(n_true), 6) AS weighted_precision,
               round(sum(recall * n_true) / sum(n_true), 6) AS weighted_recall FROM by_class""",
    "confusion": "WITH " + _COUNTS + """
        SELECT label, CAST(coalesce(sum(n) FILTER (WHERE prediction = 0), 0) AS BIGINT) AS predicted_0,
               CAST(coalesce(sum(n) FILTER (WHERE prediction = 1), 0) AS BIGINT) AS predicted_1
        FROM counts GROUP BY label""",
    "eval_by_class": "WITH " + _BY_CLASS + """
        SELECT class, CAST(n_true AS BIGINT) AS n_true, round(precision, 6) AS precision,
               round(recall, 6) AS recall, round(f1, 6) AS f1 FROM by_class""",
    "confidence": _over("results", """
        SELECT id, prediction, CAST(confidence_score AS DOUBLE) AS confidence_score FROM results"""),
    "low_confidence": _over("results", f"""
        SELECT id, tweet, prediction FROM results WHERE {_FAILED}"""),
    "daily_word_freq": _over("results", """
        SELECT strftime(ts, '%Y-%m-%d') AS day, prediction, word, count(*) AS frequency
        FROM words GROUP BY 1, 2, 3"""),
    "retrain_input": _over("results", f"""
        SELECT id, raw_tweet AS tweet, l.toxic AS label, 'join' AS how
        FROM results r JOIN labels l ON r.id = CAST(l.doc_id AS VARCHAR) WHERE {_FAILED}
        UNION ALL
        SELECT id, raw_tweet, CASE prediction WHEN 'hate' THEN 0 ELSE 1 END, 'flip'
        FROM results WHERE {_FAILED}
        UNION ALL
        SELECT id, raw_tweet, {BUCKET} % 2, 'coin' FROM results WHERE {_FAILED}"""),
    "stream_score": _over("tweets", f"""
        SELECT id, {CLEAN} AS tweet, {CLEAN_WO} AS tweet_wo_hashtag,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_stamp, 1 AS is_classified, 0 AS disagrees FROM tweets"""),
    "score_queue": _over("tweets", f"""
        SELECT id, {CLEAN} AS tweet, {CLEAN_WO} AS tweet_wo_hashtag, 0 AS is_bad FROM tweets WHERE CAST(id AS BIGINT) % 7 <> 0
        UNION ALL SELECT id, {CLEAN}, {CLEAN_WO}, 0 FROM (
          SELECT sha256(length(key) || ':' || key || length(text) || ':' || text) AS id, text AS tweet FROM (
            SELECT CAST(doc_id AS VARCHAR) AS key, text FROM documents ORDER BY md5(key), key LIMIT 100))
        UNION ALL SELECT id, NULL, NULL, 1 FROM tweets WHERE CAST(id AS BIGINT) % 7 = 0"""),
    "distinct_words_sketch": _over("results", """
        SELECT prediction, count(*) AS n_words, count(DISTINCT word) AS distinct_words, 1 AS is_close
        FROM words GROUP BY 1"""),
    "top_words_sketch": _over("results", """
        SELECT word, 1 AS is_within FROM words GROUP BY word ORDER BY count(*) DESC, word LIMIT 20"""),
    "stream_dedup": _over("tweets", "SELECT id, tweet FROM tweets"),
}
ORACLE["score_refit_check"] = ORACLE["score_check"]
ORACLE["stream_daily_words"] = ORACLE["daily_word_freq"]
