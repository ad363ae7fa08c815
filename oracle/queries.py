"""oracle_sql(): DuckDB SQL per registered query key."""

from __future__ import annotations

from oracle.duckdb_sql import (COUNTS, LEXICONS, POSTS, RANKED, TOKS, bucket, clean_text, delims, joined, punct,
                               rebuilt, repair, strip_html, token_steps, unescape, ws_tokens, HTML_TITLE, WS_RUN)

ORACLE: dict[str, str] = {}


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LEX = (POSTS, TOKS, COUNTS, RANKED, LEXICONS)


def md5int(key_sql: str) -> str:
    return f"('0x' || substr(md5({key_sql}), 1, 8))::BIGINT"


def report(src: str, col: str = "tokens") -> str:
    return f"SELECT id, len({col})::BIGINT AS n_tokens, {joined(col)} AS {col} FROM {src}"


LONG_TOKS = "long AS (SELECT id, unnest(tokens) AS tok, unnest(range(len(tokens))) AS pos FROM toks)"
IDS = "ids AS (SELECT id FROM toks)"

# ------------------------------------------------------------------ B
ORACLE["title_weighting"] = W(POSTS) + "SELECT id, repeat(' ' || title, 3) AS triple_title FROM posts"
ORACLE["concat_features"] = W(POSTS) + "SELECT id, repeat(' ' || title, 3) || '' || content AS ttl_ctxt FROM posts"
ORACLE["thread_label_encode"] = W(POSTS) + (
    "SELECT id, thread, (dense_rank() OVER (ORDER BY thread) - 1)::BIGINT AS thread_id FROM posts")
ORACLE["filter_thread"] = W(POSTS) + f"SELECT id, title, {joined('tags')} AS tags FROM posts WHERE thread = 'fr'"
ORACLE["distinct_threads"] = W(POSTS) + "SELECT DISTINCT thread FROM posts"
ORACLE["view_post"] = W(POSTS) + (
    f"SELECT id, thread, title, content, {joined('tags')} AS tags FROM posts "
    f"ORDER BY {md5int(chr(39) + '7|' + chr(39) + ' || cast(id AS VARCHAR)')}, id LIMIT 3")
ORACLE["train_head_n"] = W(POSTS) + (
    f"SELECT id, thread, title FROM posts WHERE {bucket('id', 4)} <> 0 "
    f"ORDER BY {md5int(chr(39) + 'order|' + chr(39) + ' || cast(id AS VARCHAR)')}, id LIMIT 100")

# ------------------------------------------------------------------ C
ORACLE["repair_encoding"] = f"SELECT doc_id AS id, {repair('text')} AS text FROM documents"
ORACLE["strip_delimiters"] = f"SELECT doc_id AS id, {delims('text')} AS text FROM documents"
ORACLE["remove_punctuation"] = f"SELECT doc_id AS id, {punct('text')} AS text FROM documents"
ORACLE["tokenize"] = report(f"(SELECT doc_id AS id, {ws_tokens('text')} AS tokens FROM documents)")
ORACLE["clean_text"] = report(f"(SELECT doc_id AS id, {clean_text('text')} AS tokens FROM documents)")
ORACLE["strip_html"] = (
    f"SELECT page_id, trim(regexp_replace({unescape(f'regexp_extract(html, {chr(39)}{HTML_TITLE}{chr(39)}, 1)')}, "
    f"'{WS_RUN}', ' ', 'g')) AS title, {strip_html('html')} AS text FROM pages")


def _token_step_query(ner: bool, stop: bool, lemma: bool) -> str:
    return W(*LEX, LONG_TOKS, IDS, token_steps("long", ner, stop, lemma)) + report(rebuilt("ids", "steps_out"))


ORACLE["remove_stopwords"] = _token_step_query(False, True, False)
ORACLE["entity_uppercase"] = _token_step_query(True, False, False)
ORACLE["lemmatize"] = _token_step_query(False, False, True)

TTL = "repeat(' ' || title, 3) || ' ' || content"


def _clean_cte(name: str, text_sql: str, ner: bool, stop: bool, lemma: bool, legacy: bool = False,
               prefix: str = "") -> list[str]:
    """CTEs ending in ``name`` (id, tokens) for the cleaning chain over posts."""
    if legacy:
        first = ws_tokens(repair(text_sql))
    else:
        first = ws_tokens(punct(repair(strip_html(text_sql))))
    ctes = [
        f"{prefix}ct AS (SELECT id, {first} AS tokens FROM posts)",
        f"{prefix}cl AS (SELECT id, unnest(tokens) AS tok, unnest(range(len(tokens))) AS pos FROM {prefix}ct)",
        token_steps(f"{prefix}cl", ner, stop, lemma, prefix),
    ]
    if legacy:
        ctes.append(f"{prefix}cr AS {rebuilt(f'{prefix}ct', f'{prefix}steps_out')}")
        ctes.append(f"{name} AS (SELECT id, {ws_tokens(punct(strip_html(joined('tokens'))))} AS tokens FROM {prefix}cr)")
    else:
        ctes.append(f"{name} AS {rebuilt(f'{prefix}ct', f'{prefix}steps_out')}")
    return ctes


ORACLE["clean_data"] = W(*LEX, *_clean_cte("cleaned", TTL, True, True, True)) + report("cleaned")
ORACLE["clean_data_legacy"] = W(*LEX, *_clean_cte("cleaned", TTL, True, True, True, legacy=True)) + report("cleaned")
ORACLE["prepare_posts"] = W(*LEX, *_clean_cte("cleaned", TTL, True, True, True)) + (
    f"SELECT p.id, p.thread, len(c.tokens)::BIGINT AS n_tokens, {joined('c.tokens')} AS tokens, "
    f"{joined(clean_text(joined('p.tags')))} AS tags FROM posts p JOIN cleaned c ON p.id = c.id")


def _variants() -> str:
    ctes, selects = [], []
    for s in (True, False):
        for n in (True, False):
            for l in (True, False):
                name = f"stop{int(s)}_ner{int(n)}_lemma{int(l)}"
                ctes += _clean_cte(f"v_{name}", TTL, n, s, l, prefix=f"{name}_")
                selects.append(
                    f"SELECT '{name}' AS config, {str(s).upper()} AS rem_stopwords, {str(n).upper()} AS ner, "
                    f"{str(l).upper()} AS lemmatize, (SELECT count(*) FROM v_{name})::BIGINT AS n_docs, "
                    f"(SELECT sum(len(tokens)) FROM v_{name})::BIGINT AS n_tokens, "
                    f"(SELECT count(DISTINCT t) FROM (SELECT unnest(tokens) AS t FROM v_{name}))::BIGINT AS vocab_size")
    return W(*LEX, *ctes) + "\nUNION ALL\n".join(selects)


ORACLE["prep_variants"] = _variants()

# ------------------------------------------------------------------ D
TAGC = "tagc AS (SELECT term, count(*)::BIGINT AS count FROM (SELECT unnest(tags) AS term FROM posts) GROUP BY term)"
ORACLE["token_counts"] = W(POSTS, TOKS, COUNTS) + "SELECT term, count FROM counts"
ORACLE["tag_counts"] = W(POSTS, TAGC) + "SELECT term, count FROM tagc"
ORACLE["doc_bag"] = (f"SELECT id, term, count(*)::BIGINT AS tf FROM "
                     f"(SELECT doc_id AS id, unnest({ws_tokens('text')}) AS term FROM documents) GROUP BY id, term")
ORACLE["top_tags"] = W(POSTS, TAGC) + (
    "SELECT term, count, rank FROM (SELECT term, count, "
    "row_number() OVER (ORDER BY count DESC, term)::BIGINT AS rank FROM tagc) WHERE rank > 3 AND rank <= 23")
ORACLE["top_tokens"] = W(POSTS, TOKS, COUNTS) + (
    "SELECT term, count, rank FROM (SELECT term, count, "
    "row_number() OVER (ORDER BY count DESC, term)::BIGINT AS rank FROM counts) WHERE rank <= 50")
ORACLE["rarest_terms"] = W(POSTS, TOKS, COUNTS) + (
    "SELECT term, count, rank FROM (SELECT term, count, "
    "row_number() OVER (ORDER BY count ASC, term)::BIGINT AS rank FROM counts) WHERE rank <= 10")
ORACLE["thread_tag_weights"] = W(POSTS) + """SELECT thread, tag, count, round(count / max(count) OVER (PARTITION BY thread), 6) AS weight, rank
FROM (SELECT thread, tag, count, row_number() OVER (PARTITION BY thread ORDER BY count DESC, tag)::BIGINT AS rank
      FROM (SELECT thread, tag, count(*)::BIGINT AS count FROM (SELECT thread, unnest(tags) AS tag FROM posts) GROUP BY thread, tag))
WHERE rank <= 20"""
POSF = """posf AS (SELECT coalesce(thread, 'ALL') AS thread, pos, count(*)::BIGINT AS count
  FROM (SELECT t.thread, coalesce(l.pos, 'X') AS pos FROM (SELECT thread, unnest(tokens) AS token FROM toks) t
        LEFT JOIN poslex l ON t.token = l.token)
  GROUP BY GROUPING SETS ((pos, thread), (pos)))"""
ORACLE["pos_frequency"] = W(*LEX, POSF) + "SELECT thread, pos, count FROM posf"
ORACLE["verb_noun_ratio"] = W(*LEX, POSF) + """SELECT thread, verbs, nouns, CASE WHEN nouns > 0 THEN round(verbs / nouns, 6) END AS verb_noun_ratio
FROM (SELECT thread, sum(CASE WHEN pos = 'VERB' THEN count ELSE 0 END)::BIGINT AS verbs,
             sum(CASE WHEN pos = 'NOUN' THEN count ELSE 0 END)::BIGINT AS nouns FROM posf GROUP BY thread)"""
ORACLE["corpus_summary"] = W(POSTS, TOKS) + """SELECT (SELECT count(*) FROM posts)::BIGINT AS n_docs,
  (SELECT count(DISTINCT t) FROM (SELECT unnest(tags) AS t FROM posts))::BIGINT AS n_unique_tags,
  (SELECT count(DISTINCT t) FROM (SELECT unnest(tokens) AS t FROM toks))::BIGINT AS n_unique_words,
  (SELECT sum(len(tokens)) FROM toks)::BIGINT AS n_tokens"""

# ------------------------------------------------------------------ E
BOW = "bow AS (SELECT id, term, count(*)::BIGINT AS tf FROM (SELECT id, unnest(tokens) AS term FROM toks) GROUP BY id, term)"
ORACLE["bag_of_words"] = W(POSTS, TOKS, BOW) + "SELECT id, term, tf FROM bow"
ORACLE["tfidf"] = W(POSTS, TOKS, BOW) + """, dfq AS (SELECT term, count(*) AS df FROM bow GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
w AS (SELECT b.id, b.term, b.tf * (ln((1e0 + nd.n) / (1e0 + dfq.df)) + 1e0) AS w FROM bow b JOIN dfq USING (term), nd)
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS tfidf FROM w"""
ORACLE["tags_in_post"] = W(POSTS, TOKS, TAGC) + (
    "SELECT DISTINCT t.id, t.tag FROM (SELECT id, unnest(tokens) AS tag FROM toks) t JOIN tagc c ON t.tag = c.term")
ORACLE["tag_freq_in_post"] = W(POSTS, TOKS, TAGC) + (
    "SELECT t.id, t.tag, count(*)::BIGINT AS tf FROM (SELECT id, unnest(tokens) AS tag FROM toks) t "
    "JOIN tagc c ON t.tag = c.term GROUP BY t.id, t.tag")
ORACLE["predict_target"] = W(POSTS, TOKS, TAGC) + (
    ", own AS (SELECT t.id, t.tag, count(*)::BIGINT AS n FROM (SELECT id, unnest(tokens) AS tag FROM toks) t "
    "JOIN tagc c ON t.tag = c.term GROUP BY t.id, t.tag) "
    "SELECT 'thread' AS target, id, thread AS tag, (dense_rank() OVER (ORDER BY thread) - 1)::BIGINT AS value FROM posts "
    "UNION ALL SELECT 'tag_counts', id, tag, n FROM own UNION ALL SELECT 'tag_bool', id, tag, 1::BIGINT FROM own")
ORACLE["matrix_shape"] = W(POSTS, TOKS, BOW) + """SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
  count(DISTINCT term)::BIGINT AS n_terms, count(*)::BIGINT AS nnz,
  round(count(*) / ((SELECT count(*) FROM documents) * count(DISTINCT term)), 6) AS density FROM bow"""
_U = md5int("'42|' || cast(l.id AS VARCHAR) || ':' || cast(l.pos AS VARCHAR)")
ORACLE["subsample_tokens"] = W(POSTS, TOKS, LONG_TOKS, IDS) + f""", freq AS (SELECT tok, count(*) AS c FROM long GROUP BY tok),
tot AS (SELECT sum(c) AS t FROM freq),
kept AS (SELECT l.id, l.pos, CASE WHEN {_U} / 4294967296.0 < least(1.0, sqrt(1e-3 / (f.c / tot.t)) + 1e-3 / (f.c / tot.t))
                THEN l.tok END AS tok FROM long l JOIN freq f ON l.tok = f.tok, tot)
""" + report(rebuilt("ids", "kept"))

WV = "wv AS (SELECT 'w' || cast(vec_id AS VARCHAR) AS word, embedding::DOUBLE[] AS vector, label FROM embeddings)"
BAGS = """bags AS (SELECT e.vec_id AS id, j AS pos, 'w' || cast((e.vec_id * 7 + j * 13) % nv.n AS VARCHAR) AS word
  FROM embeddings e, (SELECT count(*) AS n FROM embeddings) nv, range(5) t(j))"""


def docvec(name: str, src: str) -> str:
    return f"""{name}_x AS (SELECT b.id, unnest(range(len(v.vector))) AS dim, unnest(v.vector) AS x FROM {src} b JOIN wv v ON b.word = v.word),
{name}_l AS (SELECT id, dim, avg(x) AS value FROM {name}_x GROUP BY id, dim),
{name} AS (SELECT id, list(value ORDER BY dim) AS vector FROM {name}_l GROUP BY id)"""


ORACLE["doc_mean_vector"] = W(WV, BAGS, docvec("dv", "bags")) + (
    "SELECT b.id, coalesce(dim, -1)::BIGINT AS dim, round(value, 6) AS value FROM (SELECT DISTINCT id FROM bags) b LEFT JOIN dv_l l ON b.id = l.id")
TRUE_TAGS = "tt AS (SELECT b.* FROM bags b WHERE b.word IN (SELECT word FROM wv WHERE label < 5))"
ORACLE["doc_embedding_matrix"] = W(WV, BAGS, TRUE_TAGS, docvec("tv", "tt")) + (
    "SELECT b.id, coalesce(dim, -1)::BIGINT AS dim, round(value, 6) AS value FROM (SELECT DISTINCT id FROM bags) b LEFT JOIN tv_l l ON b.id = l.id")
ORACLE["similar_by_word"] = W(WV) + """SELECT word, neighbor, round(cosine, 6) AS cosine, rank FROM (
  SELECT a.word, b.word AS neighbor, list_cosine_similarity(a.vector, b.vector) AS cosine,
         row_number() OVER (PARTITION BY a.word ORDER BY list_cosine_similarity(a.vector, b.vector) DESC, b.word)::BIGINT AS rank
  FROM wv a JOIN wv b ON a.word <> b.word) WHERE rank <= 10"""
CAND = """cand AS (SELECT id, word, cosine, rank FROM (
  SELECT d.id, w.word, list_cosine_similarity(d.vector, w.vector) AS cosine,
         row_number() OVER (PARTITION BY d.id ORDER BY list_cosine_similarity(d.vector, w.vector) DESC, w.word)::BIGINT AS rank
  FROM dv d, wv w) WHERE rank <= {k})"""
ORACLE["similar_by_vector"] = W(WV, BAGS, docvec("dv", "bags"), CAND.format(k=10)) + (
    "SELECT id, word, round(cosine, 6) AS cosine, rank FROM cand")
ORACLE["minmax_scale_2d"] = W(WV) + """SELECT word,
  round((vector[1] - min(vector[1]) OVER ()) / (max(vector[1]) OVER () - min(vector[1]) OVER ()), 6) AS x,
  round((vector[2] - min(vector[2]) OVER ()) / (max(vector[2]) OVER () - min(vector[2]) OVER ()), 6) AS y FROM wv"""

# ------------------------------------------------------------------ F
TAGV = "tagv AS (SELECT word AS term FROM wv WHERE label < 5)"
PRED = """pred AS (SELECT id, word AS tag, cosine, tag_rank FROM (
  SELECT id, word, cosine, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, word)::BIGINT AS tag_rank
  FROM cand WHERE cosine > 0.2 AND word IN (SELECT term FROM tagv)) WHERE tag_rank <= 5)"""
AUTO = """auto AS (SELECT i.id, coalesce(p.tags, []) AS tags FROM (SELECT DISTINCT id FROM bags) i
  LEFT JOIN (SELECT id, list(tag ORDER BY tag_rank) AS tags FROM pred GROUP BY id) p ON i.id = p.id)"""
FBASE = (WV, BAGS, docvec("dv", "bags"), CAND.format(k=500), TAGV, PRED, AUTO)
ORACLE["tag_candidates"] = W(*FBASE) + "SELECT id, word, round(cosine, 6) AS cosine, rank FROM cand"
ORACLE["predict_tags"] = W(*FBASE) + "SELECT id, tag, round(cosine, 6) AS cosine, tag_rank FROM pred"
ORACLE["auto_tag"] = W(*FBASE) + f"SELECT id, len(tags)::BIGINT AS n_tags, {joined('tags')} AS tags FROM auto"
EVAL = """truth AS (SELECT id, list_distinct(list(word)) AS tags FROM bags WHERE word IN (SELECT term FROM tagv) GROUP BY id),
ev AS (SELECT coalesce(t.id, a.id) AS id, coalesce(t.tags, []) AS tr, coalesce(list_distinct(a.tags), []) AS pr
  FROM truth t FULL JOIN auto a ON t.id = a.id),
per AS (SELECT id, len(tr)::BIGINT AS n_true, len(pr)::BIGINT AS n_pred,
  len(list_filter(tr, lambda x: list_contains(pr, x)))::BIGINT AS hits,
  len(list_filter(tr, lambda x: NOT list_contains(pr, x)))::BIGINT AS misses FROM ev)"""
ORACLE["evaluate_autotag"] = W(*FBASE, EVAL) + "SELECT * FROM per"
ORACLE["autotag_summary"] = W(*FBASE, EVAL) + """SELECT count(*)::BIGINT AS n_posts, sum(hits)::BIGINT AS hits, sum(misses)::BIGINT AS misses,
  CASE WHEN sum(misses) > 0 THEN round(sum(hits) / sum(misses), 6) END AS hit_miss_ratio,
  CASE WHEN sum(n_pred) > 0 THEN round(sum(hits) / sum(n_pred), 6) END AS precision,
  CASE WHEN sum(n_true) > 0 THEN round(sum(hits) / sum(n_true), 6) END AS recall FROM per"""

# ------------------------------------------------------------------ H
LAB = f"lab AS (SELECT id, thread, CASE WHEN {bucket('id', 4)} = 0 THEN 'test' ELSE 'train' END AS split FROM posts)"


def nb_sql(name: str, train_where: str, alpha: float = 1.0, fit_prior: bool = True, lab: str = "lab",
           prior: str | None = None) -> list[str]:
    """CTEs ending in ``{name}`` (id, prediction) — multinomial NB fitted on rows of ``lab`` matching train_where."""
    p = name
    fitted = f"ln({p}_d.nd / (SELECT count(*) FROM {p}_tr))" if fit_prior else f"-ln((SELECT count(*) FROM {p}_d))"
    prior = prior or fitted
    return [
        f"{p}_tr AS (SELECT id, thread AS label FROM {lab} WHERE {train_where})",
        f"{p}_cnt AS (SELECT t.label, b.term, sum(b.tf) AS n FROM bow b JOIN {p}_tr t ON b.id = t.id GROUP BY t.label, b.term)",
        f"{p}_voc AS (SELECT DISTINCT term FROM {p}_cnt)",
        f"{p}_d AS (SELECT label, count(*) AS nd FROM {p}_tr GROUP BY label)",
        f"""{p}_cls AS (SELECT {p}_d.label, {prior} AS lp,
            ln(coalesce(tot.N, 0) + {alpha} * (SELECT count(*) FROM {p}_voc)) AS ld
          FROM {p}_d LEFT JOIN (SELECT label, sum(n) AS N FROM {p}_cnt GROUP BY label) tot ON {p}_d.label = tot.label)""",
        f"{p}_len AS (SELECT id, sum(tf) AS L FROM bow WHERE term IN (SELECT term FROM {p}_voc) GROUP BY id)",
        f"""{p}_part AS (SELECT b.id, c.label, sum(b.tf * (ln(c.n + {alpha}) - ln({alpha}))) AS s
          FROM bow b JOIN {p}_cnt c ON b.term = c.term GROUP BY b.id, c.label)""",
        f"""{p}_sc AS (SELECT l.id, c.label, c.lp + coalesce(dl.L, 0) * (ln({alpha}) - c.ld) + coalesce(pt.s, 0) AS score
          FROM {lab} l CROSS JOIN {p}_cls c LEFT JOIN {p}_len dl ON l.id = dl.id
          LEFT JOIN {p}_part pt ON pt.id = l.id AND pt.label = c.label)""",
        f"""{name} AS (SELECT id, label AS prediction FROM (SELECT id, label,
          row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS r FROM {p}_sc) WHERE r = 1)""",
    ]


def metrics_sql(src: str, by: str) -> str:
    """(by, metric, value) from CTE ``src`` with columns by, thread, prediction."""
    return f"""mc AS (SELECT {by}, thread, prediction, count(*) AS n FROM {src} GROUP BY {by}, thread, prediction),
pc AS (SELECT {by}, cls, sum(tp) AS tp, sum(t) AS n_true, sum(p) AS n_pred FROM (
    SELECT {by}, thread AS cls, n AS t, 0 AS p, CASE WHEN thread = prediction THEN n ELSE 0 END AS tp FROM mc
    UNION ALL SELECT {by}, prediction AS cls, 0 AS t, n AS p, 0 AS tp FROM mc) GROUP BY {by}, cls),
agg AS (SELECT {by}, sum(tp) / sum(n_true) AS accuracy,
    avg(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END) AS precision_macro,
    avg(CASE WHEN n_true > 0 THEN tp / n_true ELSE 0 END) AS recall_macro,
    avg(CASE WHEN n_true + n_pred > 0 THEN 2.0 * tp / (n_true + n_pred) ELSE 0 END) AS f1_macro FROM pc GROUP BY {by}),
met AS (SELECT {by}, 'accuracy' AS metric, round(accuracy, 6) AS value FROM agg
    UNION ALL SELECT {by}, 'precision_macro', round(precision_macro, 6) FROM agg
    UNION ALL SELECT {by}, 'recall_macro', round(recall_macro, 6) FROM agg
    UNION ALL SELECT {by}, 'f1_macro', round(f1_macro, 6) FROM agg)"""


HBASE = (POSTS, TOKS, BOW, LAB, *nb_sql("nb", "split = 'train'"),
         "np AS (SELECT l.id, l.split, l.thread, n.prediction FROM lab l JOIN nb n ON l.id = n.id)")
ORACLE["train_test_split"] = W(POSTS, LAB) + "SELECT id, split FROM lab"
ORACLE["naive_bayes"] = W(*HBASE) + "SELECT id, split, thread, prediction FROM np"
ORACLE["classification_metrics"] = W(*HBASE, metrics_sql("np", "split")) + "SELECT split, metric, value FROM met"
ORACLE["nb_mllib"] = W(  # MLlib smooths the class prior as it does the terms
    POSTS, TOKS, BOW, LAB, *nb_sql("nb", "split = 'train'", prior="ln((nb_d.nd + 1.0) / ((SELECT count(*) FROM nb_tr) "
                                   "+ (SELECT count(*) FROM nb_d)))"),
    "np AS (SELECT l.id, l.split, l.thread, n.prediction FROM lab l JOIN nb n ON l.id = n.id)",
    metrics_sql("np", "split")) + "SELECT split, metric, value FROM met"
ORACLE["confusion_matrix"] = W(*HBASE) + """SELECT actual, predicted, count, round(count / sum(count) OVER (PARTITION BY actual), 6) AS share
FROM (SELECT thread AS actual, prediction AS predicted, count(*)::BIGINT AS count FROM np WHERE split = 'test' GROUP BY 1, 2)"""
ORACLE["mse_score"] = W(*HBASE) + """, ids AS (SELECT thread AS name, (dense_rank() OVER (ORDER BY thread) - 1) AS i FROM (SELECT DISTINCT thread FROM np))
SELECT split, round(avg(power(a.i - b.i, 2)), 6) AS mse, round(0.0 - avg(power(a.i - b.i, 2)), 6) AS neg_mse
FROM np JOIN ids a ON np.thread = a.name JOIN ids b ON np.prediction = b.name GROUP BY split"""
FOLD = f"fl AS (SELECT id, thread, {bucket('id', 5, 42)} AS fold FROM lab WHERE split = 'train')"
ORACLE["kfold_assign"] = W(POSTS, LAB, FOLD) + "SELECT id, fold::BIGINT AS fold FROM fl"


def _kfold() -> str:
    ctes, parts = [], []
    for f in range(5):
        ctes += nb_sql(f"f{f}", f"fold <> {f}", lab="fl")
        parts.append(f"SELECT {f} AS fold, CASE WHEN l.fold = {f} THEN 'validate' ELSE 'train' END AS split, "
                     f"l.thread, n.prediction FROM fl l JOIN f{f} n ON l.id = n.id")
    ctes.append("fp AS (" + " UNION ALL ".join(parts) + ")")
    return W(POSTS, TOKS, BOW, LAB, FOLD, *ctes, metrics_sql("fp", "fold, split")) + """SELECT split,
  round(avg(CASE WHEN metric = 'accuracy' THEN value END), 6) AS accuracy,
  round(avg(CASE WHEN metric = 'precision_macro' THEN value END), 6) AS precision_macro,
  round(avg(CASE WHEN metric = 'recall_macro' THEN value END), 6) AS recall_macro,
  round(avg(CASE WHEN metric = 'f1_macro' THEN value END), 6) AS f1_macro FROM met GROUP BY split"""


ORACLE["kfold_summary"] = _kfold()
EMB = f"""emb AS (SELECT vec_id, embedding::DOUBLE[] AS vector, label,
  CASE WHEN {bucket('vec_id', 4)} = 0 THEN 'test' ELSE 'train' END AS split FROM embeddings)"""
ORACLE["knn_classify"] = W(EMB) + """, nn AS (SELECT q.vec_id, t.label, row_number() OVER (PARTITION BY q.vec_id
    ORDER BY list_distance(q.vector, t.vector), cast(t.vec_id AS VARCHAR)) AS r
  FROM emb q JOIN emb t ON q.split = 'test' AND t.split = 'train'),
votes AS (SELECT vec_id, label, count(*) AS v FROM nn WHERE r <= 50 GROUP BY vec_id, label),
best AS (SELECT vec_id, label AS prediction FROM (SELECT vec_id, label,
  row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, label) AS r FROM votes) WHERE r = 1)
SELECT e.vec_id, e.label::BIGINT AS label, b.prediction::BIGINT AS prediction FROM emb e JOIN best b ON e.vec_id = b.vec_id"""


def _nb_grid() -> str:
    ctes, parts = [], []
    gi = 0
    for a in (0.1, 0.5, 1.0, 2.0):
        for fp in (True, False):
            for f in range(5):
                name = f"g{gi}_{f}"
                ctes += nb_sql(name, f"fold <> {f}", a, fp, lab="fl")
                parts.append(f"SELECT {gi} AS gi, {a} AS alpha, {str(fp).upper()} AS fit_prior, {f} AS fold, "
                             f"l.thread, n.prediction FROM fl l JOIN {name} n ON l.id = n.id WHERE l.fold = {f}")
            gi += 1
    ctes.append("gp AS (" + "\nUNION ALL ".join(parts) + ")")
    return W(POSTS, TOKS, BOW, LAB, FOLD, *ctes, metrics_sql("gp", "gi, alpha, fit_prior, fold")) + """, f1 AS (
  SELECT gi, alpha, fit_prior, round(avg(value), 6) AS f1_macro FROM met WHERE metric = 'f1_macro' GROUP BY gi, alpha, fit_prior)
SELECT alpha::DOUBLE AS alpha, fit_prior, f1_macro, row_number() OVER (ORDER BY f1_macro DESC, gi) = 1 AS best FROM f1"""


ORACLE["nb_gridsearch"] = _nb_grid()

# ------------------------------------------------------------------ A
ORACLE["src_posts_by_thread"] = W(POSTS) + f"SELECT id, thread, title, content, {joined('tags')} AS tags FROM posts"
ORACLE["cap_per_thread"] = W(POSTS) + (
    "SELECT id, thread FROM (SELECT id, thread, row_number() OVER (PARTITION BY thread ORDER BY id) AS r FROM posts) "
    "WHERE r <= 100")
ORACLE["union_files"] = W(POSTS) + """SELECT id, thread, title, content FROM posts
UNION ALL SELECT conv_id * 1000 + turn AS id, role AS thread, NULL AS title, text AS content FROM conversations"""
ORACLE["dataset_roundtrip"] = W(POSTS) + (
    f"SELECT id, thread, title, content, {joined('tags')} AS tags FROM posts")
ORACLE["counts_roundtrip"] = W(POSTS, TOKS, COUNTS) + "SELECT term, count FROM counts"
ORACLE["csv_export_import"] = W(POSTS) + (
    f"SELECT id, thread, title, content, len(tags)::BIGINT AS n_tags, {joined('tags')} AS tags FROM posts")

# ------------------------------------------------------------------ G (fixed topic table: one topic per thread)
TOPIC = """phi AS (SELECT topic, term, c / sum(c) OVER (PARTITION BY topic) AS phi FROM
  (SELECT thread AS topic, term, count(*) AS c FROM (SELECT thread, unnest(tokens) AS term FROM toks) GROUP BY 1, 2)),
share AS (SELECT topic, m / sum(m) OVER () AS share FROM (SELECT thread AS topic, sum(len(tokens)) AS m FROM toks GROUP BY 1)),
j AS (SELECT p.topic, p.term, p.phi, s.share, p.phi * s.share AS pw_t FROM phi p JOIN share s ON p.topic = s.topic),
pw AS (SELECT term, sum(pw_t) AS p_w FROM j GROUP BY term),
dist AS (SELECT j.term, sum(CASE WHEN j.pw_t / pw.p_w > 0 THEN (j.pw_t / pw.p_w) * ln((j.pw_t / pw.p_w) / j.share) ELSE 0 END)
  AS distinctiveness FROM j JOIN pw ON j.term = pw.term GROUP BY j.term),
ts AS (SELECT pw.term, p_w, distinctiveness, p_w * distinctiveness AS saliency FROM pw JOIN dist ON pw.term = dist.term)"""
ORACLE["topic_share"] = W(POSTS, TOKS, TOPIC) + "SELECT topic, round(share, 6) AS share FROM share"
ORACLE["topic_relevance"] = W(POSTS, TOKS, TOPIC) + """, rel AS (SELECT p.topic, p.term, p.phi,
  0.6 * ln(p.phi) + (1.0 - 0.6) * ln(p.phi / ts.p_w) AS relevance, ts.saliency FROM phi p JOIN ts ON p.term = ts.term WHERE p.phi > 0)
SELECT topic, term, round(phi, 6) AS phi, round(relevance, 6) AS relevance, round(saliency, 6) AS saliency, rank
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY relevance DESC, term)::BIGINT AS rank FROM rel) WHERE rank <= 30"""
ORACLE["topic_distance"] = W(POSTS, TOKS, TOPIC) + """, tp AS (SELECT DISTINCT topic FROM phi),
pairs AS (SELECT a.topic AS topic_a, b.topic AS topic_b FROM tp a JOIN tp b ON a.topic < b.topic),
terms AS (SELECT DISTINCT term FROM phi),
g AS (SELECT pr.topic_a, pr.topic_b, coalesce(pa.phi, 0) AS p, coalesce(pb.phi, 0) AS q
  FROM pairs pr CROSS JOIN terms t LEFT JOIN phi pa ON pa.topic = pr.topic_a AND pa.term = t.term
  LEFT JOIN phi pb ON pb.topic = pr.topic_b AND pb.term = t.term)
SELECT topic_a, topic_b, round(sum(0.5 * CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2.0)) ELSE 0 END
  + 0.5 * CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2.0)) ELSE 0 END), 6) AS js FROM g GROUP BY topic_a, topic_b"""

ORACLE["stream_token_counts"] = ORACLE["token_counts"]
# the trained vectors are no SQL; every word must have one of the asked dimension
ORACLE["word2vec_train"] = W(POSTS, TOKS, COUNTS) + "SELECT term AS word, 128::BIGINT AS dim FROM counts"
ORACLE["tag_aware_embedding"] = W(POSTS, TAGC) + "SELECT term AS word, 128::BIGINT AS dim FROM tagc"

ORACLE["project_2d"] = W(WV) + """, m AS (SELECT i, avg(x) AS m FROM (SELECT unnest(range(len(vector))) AS i, unnest(vector) AS x FROM wv) GROUP BY i),
l AS (SELECT word, unnest(range(len(vector))) AS i, unnest(vector) AS x FROM wv)
SELECT word, round(sum((x - m.m) * (x - m.m)), 6) AS spread FROM l JOIN m USING (i) GROUP BY word"""
ORACLE["cooccurrence_ppmi"] = W(POSTS, TOKS) + """, pos AS (SELECT id, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS i FROM toks),
once AS (SELECT a.t AS word, b.t AS context FROM pos a JOIN pos b ON a.id = b.id AND b.i IN (a.i + 1, a.i + 2)),
both_ AS (SELECT word, context FROM once UNION ALL SELECT context, word FROM once),
n AS (SELECT word, context, count(*)::BIGINT AS n FROM both_ GROUP BY word, context),
w AS (SELECT word, sum(n)::DOUBLE AS s FROM n GROUP BY word), tot AS (SELECT sum(n)::DOUBLE AS s FROM n)
SELECT n.word, n.context, n.n, round(greatest(ln(n.n * tot.s / (a.s * b.s)), 0), 6) AS ppmi
FROM n JOIN w a ON n.word = a.word JOIN w b ON n.context = b.word, tot WHERE n.word <= n.context"""


def _staged() -> str:
    totals = ", ".join(f"sum(CASE WHEN pos % 10 = {c} THEN x ELSE 0 END) OVER (PARTITION BY vec_id ORDER BY pos) AS t{c}" for c in range(10))
    listed = ", ".join(f"round(t{c}, 9)" for c in range(10))
    return f"""WITH e AS (SELECT vec_id, label, CASE WHEN {bucket('vec_id', 4)} = 0 THEN 'test' ELSE 'train' END AS split,
  unnest(range(len(embedding))) AS pos, unnest(embedding::DOUBLE[]) AS x FROM embeddings),
c AS (SELECT split, label, pos, {totals} FROM e),
p AS (SELECT split, label, pos + 1 AS round, list_position([{listed}], list_max([{listed}])) - 1 AS said FROM c)
SELECT split, round::BIGINT AS round, round(avg(CASE WHEN said <> label THEN 1.0 ELSE 0.0 END), 6) AS error FROM p GROUP BY split, round"""


ORACLE["staged_error_scores"] = _staged()
ORACLE["saved_pipeline"] = ORACLE["naive_bayes"]
ORACLE["topic_map"] = ORACLE["topic_distance"].replace("SELECT topic_a, topic_b, round(sum(", "SELECT topic_a, topic_b, round(js, 6) AS js, round(sqrt(greatest(js, 0)), 6) AS map_distance FROM (SELECT topic_a, topic_b, (sum(") \
    .replace(", 6) AS js FROM g GROUP BY topic_a, topic_b", ") AS js FROM g GROUP BY topic_a, topic_b)")


def _em(k: int = 3, iterations: int = 2, seed: int = 42) -> str:
    """pLSA by EM: start from hashed shares, topics alike in all documents."""
    each = range(k)
    ctes = [f"u AS (SELECT term, {', '.join(f'{md5int(chr(39) + str(seed) + chr(124) + chr(39) + ' || term || ' + chr(39) + chr(124) + str(t) + chr(39))} / 4294967296.0::DOUBLE + 0.5 AS u{t}' for t in each)} FROM (SELECT DISTINCT term FROM bow))",
            f"phi0 AS (SELECT term, {', '.join(f'u{t} / sum(u{t}) OVER () AS p{t}' for t in each)} FROM u)",
            f"th0 AS (SELECT DISTINCT id, {', '.join(f'1.0::DOUBLE / {k} AS q{t}' for t in each)} FROM bow)"]
    for i in range(iterations):
        s = " + ".join(f"p{t} * q{t}" for t in each)
        ctes += [f"r{i} AS (SELECT b.id, b.term, {', '.join(f'b.tf * p{t} * q{t} / ({s}) AS r{t}' for t in each)} FROM bow b JOIN phi{i} USING (term) JOIN th{i} USING (id))",
                 f"n{i} AS (SELECT term, {', '.join(f'sum(r{t}) AS r{t}' for t in each)} FROM r{i} GROUP BY term)",
                 f"phi{i + 1} AS (SELECT term, {', '.join(f'r{t} / sum(r{t}) OVER () AS p{t}' for t in each)} FROM n{i})",
                 f"th{i + 1} AS (SELECT id, {', '.join(f'sum(r{t}) / sum({' + '.join(f'r{x}' for x in each)}) AS q{t}' for t in each)} FROM r{i} GROUP BY id)"]
    return W(POSTS, TOKS, BOW, *ctes) + f"SELECT term, {', '.join(f'round(p{t} * 1e6, 4) AS p{t}' for t in each)} FROM phi{iterations}"


ORACLE["topic_em_step"] = _em()
ORACLE["multilabel_nb"] = W(POSTS, TOKS, TAGC, LAB) + f""",
pairs AS (SELECT DISTINCT t.id, t.tag FROM (SELECT id, unnest(tokens) AS tag FROM toks) t JOIN tagc c ON t.tag = c.term),
x AS (SELECT id, split, b, count(*)::DOUBLE AS tf FROM (SELECT id, {bucket('term', 512)} AS b FROM (SELECT id, unnest(tokens) AS term FROM toks)) JOIN lab USING (id) GROUP BY id, split, b),
tr AS (SELECT id FROM lab WHERE split = 'train'), te AS (SELECT id FROM lab WHERE split = 'test'),
nb AS (SELECT b, sum(tf) AS n FROM x WHERE split = 'train' GROUP BY b),
total AS (SELECT (SELECT coalesce(sum(n), 0) FROM nb) AS n, (SELECT count(*) FROM tr)::DOUBLE AS posts),
tag AS (SELECT tag, count(*)::DOUBLE AS posts FROM pairs JOIN tr USING (id) GROUP BY tag),
ntb AS (SELECT p.tag, x.b, sum(x.tf) AS n FROM pairs p JOIN x ON p.id = x.id AND x.split = 'train' GROUP BY p.tag, x.b),
nt AS (SELECT tag, sum(n) AS n FROM ntb GROUP BY tag),
w AS (SELECT ntb.tag, ntb.b, ln(ntb.n + 1) + ln((nb.n + 1) / (nb.n - ntb.n + 1)) AS w FROM ntb JOIN nb USING (b)),
bias AS (SELECT t.tag, CASE WHEN t.posts = total.posts THEN 1e300 ELSE ln(t.posts) - ln(total.posts - t.posts) END AS prior,
  ln(total.n - coalesce(nt.n, 0) + 512) - ln(coalesce(nt.n, 0) + 512) AS per_token FROM tag t LEFT JOIN nt USING (tag), total),
doc AS (SELECT x.id, sum(x.tf) AS len, sum(-x.tf * ln(coalesce(nb.n, 0) + 1)) AS base FROM x LEFT JOIN nb USING (b) WHERE x.split = 'test' GROUP BY x.id),
part AS (SELECT x.id, w.tag, sum(x.tf * w.w) AS s FROM x JOIN w USING (b) WHERE x.split = 'test' GROUP BY x.id, w.tag),
sc AS (SELECT te.id, bias.tag, prior + coalesce(doc.base, 0) + coalesce(doc.len, 0) * per_token + coalesce(part.s, 0) > 0 AS said, p.id IS NOT NULL AS own
  FROM te CROSS JOIN bias LEFT JOIN doc ON doc.id = te.id LEFT JOIN part ON part.id = te.id AND part.tag = bias.tag
  LEFT JOIN pairs p ON p.id = te.id AND p.tag = bias.tag)
SELECT tag, 'test' AS split, count(*)::BIGINT AS n, sum(own::INT)::BIGINT AS n_true, sum(said::INT)::BIGINT AS n_pred, sum((own AND said)::INT)::BIGINT AS tp
FROM sc GROUP BY tag"""
