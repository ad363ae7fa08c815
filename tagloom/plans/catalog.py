"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator of the inventory.

Each query reads the given tables whole (or views Spark derives from them) and returns a flat result: token arrays
are reported as a joined string plus a count, floating values rounded to 6 places, integers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import text as T
from tagloom.operators import clean, columns, profile
from tagloom.session import materialize
from tagloom.sources import tables as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ------------------------------------------------------------------ shared views
def posts(spark, d):
    return V.posts(spark, d)


def toks(spark, d):
    return V.post_tokens(posts(spark, d))


def counts(spark, d):
    return profile.token_counts(toks(spark, d))


def lexicons(spark, d):
    return V.lexicons(counts(spark, d))


def docs_text(spark, d):
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def report_tokens(df: DataFrame, col: str = "tokens", keep=("id",)) -> DataFrame:
    return df.select(*keep, F.size(col).cast("bigint").alias("n_tokens"), T.joined(col).alias(col))


# ------------------------------------------------------------------ B: projections and selections
@query("title_weighting")
def q_title_weighting(spark, d):
    return columns.title_weighting(posts(spark, d), n=3).select("id", "triple_title")


@query("concat_features")
def q_concat_features(spark, d):
    df = columns.title_weighting(posts(spark, d), n=3)
    return columns.concat_features(df, "triple_title", "content", sep="").select("id", "ttl_ctxt")


@query("thread_label_encode")
def q_thread_label_encode(spark, d):
    return columns.thread_label_encode(posts(spark, d)).select("id", "thread", "thread_id")


@query("filter_thread")
def q_filter_thread(spark, d):
    return columns.filter_thread(posts(spark, d), "fr").select("id", "title", T.joined("tags").alias("tags"))


@query("distinct_threads")
def q_distinct_threads(spark, d):
    return columns.distinct_threads(posts(spark, d))


@query("view_post")
def q_view_post(spark, d):
    return columns.view_post(posts(spark, d), n=3, seed=7).withColumn("tags", T.joined("tags"))


@query("train_head_n")
def q_train_head_n(spark, d):
    return columns.train_head_n(posts(spark, d), n=100).select("id", "thread", "title")


# ------------------------------------------------------------------ C: cleaning
@query("repair_encoding")
def q_repair_encoding(spark, d):
    return docs_text(spark, d).select("id", T.repair_encoding("text").alias("text"))


@query("strip_delimiters")
def q_strip_delimiters(spark, d):
    return docs_text(spark, d).select("id", T.strip_delimiters("text").alias("text"))


@query("remove_punctuation")
def q_remove_punctuation(spark, d):
    return docs_text(spark, d).select("id", T.remove_punctuation("text").alias("text"))


@query("tokenize")
def q_tokenize(spark, d):
    return report_tokens(docs_text(spark, d).select("id", T.whitespace_tokens("text").alias("tokens")))


@query("clean_text")
def q_clean_text(spark, d):
    return report_tokens(docs_text(spark, d).select("id", T.clean_text("text").alias("tokens")))


@query("strip_html")
def q_strip_html(spark, d):
    pages = V.table(spark, d, "pages")
    return pages.select("page_id", T.html_title("html").alias("title"), T.strip_html("html").alias("text"))


@query("remove_stopwords")
def q_remove_stopwords(spark, d):
    lex = lexicons(spark, d)
    return report_tokens(clean.remove_stopwords(toks(spark, d), "tokens", lex["stop"]))


@query("entity_uppercase")
def q_entity_uppercase(spark, d):
    lex = lexicons(spark, d)
    return report_tokens(clean.entity_uppercase(toks(spark, d), lex["ent"]))


@query("lemmatize")
def q_lemmatize(spark, d):
    lex = lexicons(spark, d)
    return report_tokens(clean.lemmatize(toks(spark, d), lex["lem"]))


def _ttl_ctxt(spark, d, sep=" "):
    df = columns.title_weighting(posts(spark, d), n=3)
    return columns.concat_features(df, "triple_title", "content", sep=sep)


@query("clean_data")
def q_clean_data(spark, d):
    lex = lexicons(spark, d)
    out = clean.clean_data(_ttl_ctxt(spark, d), "ttl_ctxt", "id", stop_words=lex["stop"], entities=lex["ent"],
                           lemmas=lex["lem"])
    return report_tokens(out)


@query("clean_data_legacy")
def q_clean_data_legacy(spark, d):
    lex = lexicons(spark, d)
    out = clean.clean_data(_ttl_ctxt(spark, d), "ttl_ctxt", "id", stop_words=lex["stop"], entities=lex["ent"],
                           lemmas=lex["lem"], order="legacy")
    return report_tokens(out)


@query("prepare_posts")
def q_prepare_posts(spark, d):
    lex = lexicons(spark, d)
    out = clean.prepare_posts(posts(spark, d), stop_words=lex["stop"], entities=lex["ent"], lemmas=lex["lem"])
    return out.select("id", "thread", F.size("tokens").cast("bigint").alias("n_tokens"),
                      T.joined("tokens").alias("tokens"), T.joined("tags").alias("tags"))


@query("prep_variants")
def q_prep_variants(spark, d):
    lex = lexicons(spark, d)
    return clean.prep_variants(posts(spark, d), stop_words=lex["stop"], entities=lex["ent"], lemmas=lex["lem"])


# ------------------------------------------------------------------ D: profiling
@query("token_counts")
def q_token_counts(spark, d):
    return counts(spark, d)


@query("tag_counts")
def q_tag_counts(spark, d):
    return profile.tag_counts(posts(spark, d))


@query("doc_bag")
def q_doc_bag(spark, d):
    return profile.doc_bag(docs_text(spark, d), "text")


@query("top_tags")
def q_top_tags(spark, d):
    return profile.top_tags(profile.tag_counts(posts(spark, d)), n=20, skip=3)


@query("top_tokens")
def q_top_tokens(spark, d):
    return profile.top_tokens(counts(spark, d), n=50)


@query("rarest_terms")
def q_rarest_terms(spark, d):
    return profile.rarest_terms(counts(spark, d), 10)


@query("thread_tag_weights")
def q_thread_tag_weights(spark, d):
    return profile.thread_tag_weights(posts(spark, d), n=20)


@query("pos_frequency")
def q_pos_frequency(spark, d):
    return profile.pos_frequency(toks(spark, d), lexicons(spark, d)["pos"])


@query("verb_noun_ratio")
def q_verb_noun_ratio(spark, d):
    return profile.verb_noun_ratio(profile.pos_frequency(toks(spark, d), lexicons(spark, d)["pos"]))


@query("corpus_summary")
def q_corpus_summary(spark, d):
    p = posts(spark, d)
    return profile.corpus_summary(p.select(T.corpus_tokens(F.concat_ws("\n", "title", "content")).alias("tokens"), "tags"))


# ------------------------------------------------------------------ E: features and embeddings
from tagloom.operators import embed, features, tagging  # noqa: E402


def post_text(spark, d):
    return posts(spark, d).select("id", F.concat_ws("\n", "title", "content").alias("text"))


def bow(spark, d):
    return features.bag_of_words(post_text(spark, d), text_col="text", tokens_col=None)


def r6(c, name: str | None = None):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


@query("bag_of_words")
def q_bag_of_words(spark, d):
    return bow(spark, d)


@query("tfidf")
def q_tfidf(spark, d):
    n_docs = V.table(spark, d, "documents").count()
    return features.tfidf(bow(spark, d), n_docs=n_docs).select("id", "term", r6("tfidf"))


@query("tags_in_post")
def q_tags_in_post(spark, d):
    p = posts(spark, d)
    return features.tags_in_post(V.post_tokens(p), profile.tag_counts(p))


@query("tag_freq_in_post")
def q_tag_freq_in_post(spark, d):
    p = posts(spark, d)
    return features.tag_freq_in_post(V.post_tokens(p), profile.tag_counts(p))


@query("matrix_shape")
def q_matrix_shape(spark, d):
    b = bow(spark, d)
    n_docs = V.table(spark, d, "documents").count()
    return features.matrix_shape(b, n_rows=n_docs)


@query("subsample_tokens")
def q_subsample_tokens(spark, d):
    return report_tokens(features.subsample_tokens(toks(spark, d), sample=1e-3, seed=42))


@query("predict_target")
def q_predict_target(spark, d):
    """All three targets: the thread's number, the counts of the known tags in the post, and their presence."""
    p = posts(spark, d)
    vocab = profile.tag_counts(p)
    thread = columns.predict_target(p, "thread").join(p.select("id", F.col("thread").alias("tag")), "id").withColumnRenamed("label", "value")
    parts = [thread] + [columns.predict_target(V.post_tokens(p), t, tag_vocab=vocab) for t in ("tag_counts", "tag_bool")]
    cols = lambda df, t: df.select(F.lit(t).alias("target"), "id", "tag", F.col("value").cast("bigint").alias("value"))
    return cols(parts[0], "thread").union(cols(parts[1], "tag_counts")).union(cols(parts[2], "tag_bool"))


def long_vector(df: DataFrame, key: str) -> DataFrame:
    """(key, dim, value); a null vector is one row with dim -1 and a null value."""
    return df.select(key, F.posexplode_outer("vector").alias("dim", "value")).select(
        key, F.coalesce("dim", F.lit(-1)).cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


def wv(spark, d):
    return V.word_vectors(spark, d)


def doc_vectors(spark, d):
    return embed.mean_vectors(V.bags(spark, d), wv(spark, d))


@query("doc_mean_vector")
def q_doc_mean_vector(spark, d):
    return long_vector(doc_vectors(spark, d), "id")


def true_tags_long(spark, d):
    """Bag words that are tags (label < 5)."""
    tags = wv(spark, d).filter(F.col("label") < 5).select("word")
    return V.bags(spark, d).join(tags, "word", "left_semi")


@query("doc_embedding_matrix")
def q_doc_embedding_matrix(spark, d):
    tags = tag_vocab(spark, d).select(F.col("term").alias("word"), F.lit(True).alias("is_tag"))
    words = V.bags(spark, d).join(tags, "word", "left").select("id", F.when(F.col("is_tag"), F.col("word")).alias("word"))
    return long_vector(embed.mean_vectors(words, wv(spark, d)), "id")


@query("similar_by_word")
def q_similar_by_word(spark, d):
    return embed.similar_by_word(wv(spark, d), 10).select("word", "neighbor", r6("cosine"), "rank")


@query("similar_by_vector")
def q_similar_by_vector(spark, d):
    return embed.similar_by_vector(doc_vectors(spark, d), wv(spark, d), 10).select("id", "word", r6("cosine"), "rank")


@query("minmax_scale_2d")
def q_minmax_scale_2d(spark, d):
    xy = wv(spark, d).select("word", F.col("vector")[0].alias("x"), F.col("vector")[1].alias("y"))
    return embed.minmax_scale(xy).select("word", r6("x"), r6("y"))


@query("project_2d")
def q_project_2d(spark, d):
    """The plane's coordinates and what it leaves add up to the vector's distance from the mean."""
    p = embed.project_2d(wv(spark, d).select("word", "vector"))
    return p.select("word", r6(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("residual") * F.col("residual"), "spread"))


@query("cooccurrence_ppmi")
def q_cooccurrence_ppmi(spark, d):
    """Word pairs at most two tokens apart; the matrix is symmetric, one half is reported."""
    pairs = embed.ppmi(materialize(embed.cooccurrence(toks(spark, d), window=2), "cooccurrence"))
    return pairs.where("word <= context").select("word", "context", "n", r6("ppmi"))


@query("ppmi_vectors")
def q_ppmi_vectors(spark, d):
    v = embed.context_vectors(toks(spark, d), dim=16, window=2, powers=1)
    return v.select("word", F.array_join(F.transform("vector", lambda x: F.format_string("%.4f", x)), " ").alias("vector"))


@query("word2vec_train")
def q_word2vec_train(spark, d):
    model = embed.word2vec_train(toks(spark, d), vector_size=128, window=10, min_count=0, seed=42)
    return embed.model_vectors(model).select("word", F.size("vector").cast("bigint").alias("dim"))


@query("tag_aware_embedding")
def q_tag_aware_embedding(spark, d):
    p = posts(spark, d)
    sent = p.select("id", T.corpus_tokens(F.concat_ws("\n", "title", "content")).alias("tokens"), "tags")
    model = embed.tag_aware_embedding(sent, vector_size=128, window=10, min_count=0, seed=42)
    tags = profile.tag_counts(p).select(F.col("term").alias("word"))
    return embed.model_vectors(model).join(tags, "word", "left_semi").select(
        "word", F.size("vector").cast("bigint").alias("dim"))


# ------------------------------------------------------------------ F: auto-tagging
def tag_vocab(spark, d):
    return wv(spark, d).filter(F.col("label") < 5).select(F.col("word").alias("term"))


@query("tag_candidates")
def q_tag_candidates(spark, d):
    return tagging.tag_candidates(V.bags(spark, d), wv(spark, d), 500).select("id", "word", r6("cosine"), "rank")


def predicted(spark, d):
    cand = tagging.tag_candidates(V.bags(spark, d), wv(spark, d), 500)
    return tagging.predict_tags(cand, tag_vocab(spark, d))


@query("predict_tags")
def q_predict_tags(spark, d):
    return predicted(spark, d).select("id", "tag", r6("cosine"), "tag_rank")


def autotagged(spark, d):
    return tagging.auto_tag(V.bags(spark, d), wv(spark, d), tag_vocab(spark, d), n_neighbors=500)


@query("auto_tag")
def q_auto_tag(spark, d):
    return autotagged(spark, d).select("id", F.size("tags").cast("bigint").alias("n_tags"), T.joined("tags").alias("tags"))


def autotag_eval(spark, d):
    truth = true_tags_long(spark, d).groupBy("id").agg(F.collect_set("word").alias("tags"))
    return tagging.evaluate_autotag(autotagged(spark, d), truth)


@query("evaluate_autotag")
def q_evaluate_autotag(spark, d):
    return autotag_eval(spark, d)


@query("autotag_summary")
def q_autotag_summary(spark, d):
    return tagging.autotag_summary(autotag_eval(spark, d))


@query("auto_tag_posts")
def q_auto_tag_posts(spark, d):
    """Real posts end to end: subsampled Word2Vec over the corpus, mean vectors, 500 neighbours, tag filter, hits."""
    p = posts(spark, d)
    tokens = V.post_tokens(p)
    model = embed.word2vec_train(features.subsample_tokens(tokens, sample=1e-3, seed=42), vector_size=128, window=10)
    vectors = materialize(embed.model_vectors(model), "post_vectors")
    tagged = materialize(tagging.auto_tag_posts(tokens, vectors, profile.tag_counts(p)), "post_tags")
    per = tagging.evaluate_autotag(tagged, p.select("id", "tags"))
    return per.join(tagged, "id").select("id", "n_true", "n_pred", "hits", "misses", T.joined("tags").alias("tags"))


# ------------------------------------------------------------------ H: splits, classifiers, evaluation
from tagloom.operators import boosting, classify, evaluate, multilabel, tuning  # noqa: E402


def labelled(spark, d):
    """(id, thread, label, split) for every post; label = thread (the class)."""
    p = posts(spark, d).select("id", "thread")
    return classify.train_test_split(p).withColumn("label", F.col("thread"))


def bow_table(spark, d):
    """The corpus bag of words written once: NB fit, length and score jobs all read it (no repeated tokenising)."""
    return materialize(bow(spark, d), "bow")


def nb_predictions(spark, d, alpha=1.0, fit_prior=True):
    lab = labelled(spark, d)
    tf = bow_table(spark, d)
    train = lab.filter(F.col("split") == "train")
    model = classify.nb_fit(tf.join(train.select("id"), "id", "left_semi"), train, alpha, fit_prior)
    return classify.nb_predict(model, tf, lab.select("id")).join(lab, "id")


@query("train_test_split")
def q_train_test_split(spark, d):
    return labelled(spark, d).select("id", "split")


@query("naive_bayes")
def q_naive_bayes(spark, d):
    return nb_predictions(spark, d).select("id", "split", "thread", "prediction")


@query("classification_metrics")
def q_classification_metrics(spark, d):
    return evaluate.classification_metrics(nb_predictions(spark, d), "thread", "prediction", by=["split"])


@query("confusion_matrix")
def q_confusion_matrix(spark, d):
    test = nb_predictions(spark, d).filter(F.col("split") == "test")
    return evaluate.confusion_matrix(test, "thread", "prediction")


@query("mse_score")
def q_mse_score(spark, d):
    pred = nb_predictions(spark, d)
    mapping = columns.label_mapping(pred, "thread")
    ids = columns.thread_label_encode(pred, mapping, "thread", "y")
    ids = columns.thread_label_encode(ids, mapping, "prediction", "yhat")
    return evaluate.mse_score(ids, "y", "yhat", by=["split"])


@query("kfold_assign")
def q_kfold_assign(spark, d):
    train = labelled(spark, d).filter(F.col("split") == "train")
    return evaluate.kfold_assign(train, 5, 42).select("id", F.col("fold").cast("bigint"))


@query("kfold_summary")
def q_kfold_summary(spark, d):
    lab = evaluate.kfold_assign(labelled(spark, d).filter(F.col("split") == "train"), 5, 42)
    return evaluate.kfold_summary(classify.nb_kfold_metrics(bow_table(spark, d), lab.select("id", "label", "fold"),
                                                            k=5))


@query("knn_classify")
def q_knn_classify(spark, d):
    emb = V.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"),
                                                 F.col("embedding").cast("array<double>").alias("vector"), "label")
    emb = classify.train_test_split(emb)
    test = emb.filter(F.col("split") == "test")
    train = emb.filter(F.col("split") == "train")
    pred = classify.knn_classify(test, train, k=50)
    return test.select(F.col("id").alias("vec_id"), F.col("label").cast("bigint")).join(
        pred.select(F.col("id").alias("vec_id"), F.col("prediction").cast("bigint")), "vec_id")


# ------------------------------------------------------------------ A: sources and sinks
from tagloom.session import scratch_path  # noqa: E402
from tagloom.sources import files  # noqa: E402


def report_posts(df: DataFrame) -> DataFrame:
    return df.select("id", "thread", "title", "content", T.joined("tags").alias("tags"))


@query("src_posts_by_thread")
def q_src_posts_by_thread(spark, d):
    p = posts(spark, d)
    paths = files.write_posts_by_thread(p, scratch_path(spark, "posts_csv"))
    back = files.read_posts_by_thread(spark, paths)
    return back.select("id", "thread", "title", "content", F.coalesce("tags", F.lit("")).alias("tags"))


@query("cap_per_thread")
def q_cap_per_thread(spark, d):
    return files.cap_per_thread(posts(spark, d), 100).select("id", "thread")


@query("union_files")
def q_union_files(spark, d):
    p = posts(spark, d).select("id", "thread", "title", "content")
    conv = V.table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("role").alias("thread"),
        F.col("text").alias("content"))
    return files.union_files([p, conv]).select("id", "thread", "title", "content")


@query("dataset_roundtrip")
def q_dataset_roundtrip(spark, d):
    return report_posts(files.dataset_roundtrip(posts(spark, d), "posts"))


@query("counts_roundtrip")
def q_counts_roundtrip(spark, d):
    return files.dataset_roundtrip(counts(spark, d), "token_counts", None).select("term", "count")


@query("csv_export_import")
def q_csv_export_import(spark, d):
    path = files.export_csv(posts(spark, d), scratch_path(spark, "posts_export"))
    schema = posts(spark, d).schema
    back = files.import_csv(spark, path, schema)
    return back.select("id", "thread", "title", "content", F.size("tags").cast("bigint").alias("n_tags"),
                       T.joined("tags").alias("tags"))


# ------------------------------------------------------------------ G: topics
from tagloom.operators import topics  # noqa: E402


def fixed_topics(spark, d):
    return topics.fixed_phi_theta(toks(spark, d))


@query("topic_share")
def q_topic_share(spark, d):
    phi, theta, doc_len = fixed_topics(spark, d)
    return topics.topic_share(theta, doc_len).select("topic", r6("share"))


@query("topic_relevance")
def q_topic_relevance(spark, d):
    phi, theta, doc_len = fixed_topics(spark, d)
    rel = topics.topic_relevance(phi, topics.topic_share(theta, doc_len), lam=0.6, n=30)
    return rel.select("topic", "term", r6("phi"), r6("relevance"), r6("saliency"), "rank")


@query("topic_distance")
def q_topic_distance(spark, d):
    phi, _, _ = fixed_topics(spark, d)
    # the fixed model has one topic per thread: list them from the thread column alone (no text scan)
    ids = [r[0] for r in posts(spark, d).select("thread").distinct().collect()]  # k thread names
    return topics.topic_distance(phi, ids).select("topic_a", "topic_b", r6("js"))


def lda_fit(spark, d, k=6, max_iter=200):
    return topics.lda_train(toks(spark, d), k=k, max_iter=max_iter)


def em_topics(spark, d, k, iterations):
    return topics.topic_em(bow_table(spark, d), k, iterations)


@query("topic_em_step")
def q_topic_em_step(spark, d):
    """Two iterations from the fixed start: shares of every term in each of three topics, in millionths."""
    phi = em_topics(spark, d, 3, 2).phi
    return phi.select("term", *[F.round(F.col(f"p{t}") * 1e6, 4).alias(f"p{t}") for t in range(3)])


@query("topic_em_terms")
def q_topic_em_terms(spark, d):
    """The topic view of a trained model: shares, and the 30 most relevant terms of each topic."""
    bag = bow_table(spark, d)
    model = topics.topic_em(bag, 6, 10)
    share = topics.topic_share(model.long_theta(), bag.groupBy("id").agg(F.sum("tf").alias("n_tokens")))
    return topics.topic_relevance(model.long_phi(), share, lam=0.6, n=30).select("topic", "term", r6("phi"), r6("relevance"), r6("saliency"), "rank")


@query("topic_map")
def q_topic_map(spark, d):
    """The map of the topics gives their distances back."""
    phi, _, _ = fixed_topics(spark, d)
    ids = [r[0] for r in posts(spark, d).select("thread").distinct().collect()]
    js = materialize(topics.topic_distance(phi, ids), "topic_distance")
    at = topics.topic_map(js)
    a, b = (at.select(F.col("topic").alias(f"topic_{c}"), F.col("at").alias(f"at_{c}")) for c in "ab")
    apart = F.sqrt(F.aggregate(F.zip_with("at_a", "at_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return js.join(a, "topic_a").join(b, "topic_b").select("topic_a", "topic_b", r6("js"), r6(apart, "map_distance"))


@query("lda_train")
def q_lda_train(spark, d):
    from pyspark.ml.functions import vector_to_array

    cv, lda, out = lda_fit(spark, d)
    dist = vector_to_array("topicDistribution")
    return out.select("id", "thread", F.array_position(dist, F.array_max(dist)).cast("bigint").alias("top_topic"))


@query("topic_top_terms")
def q_topic_top_terms(spark, d):
    cv, lda, _ = lda_fit(spark, d)
    return topics.topic_top_terms(cv, lda, 10)


# ------------------------------------------------------------------ H: pyspark.ml trainers (rows-only checks)
def ml_data(spark, d, kind="bow"):
    lab = classify.train_test_split(toks(spark, d))
    data, labels = classify.labelled_features(lab, "tokens", "thread", kind,
                                              fit_on=lab.filter(F.col("split") == "train"))
    return data, labels


def ml_metrics(spark, d, name, kind="bow", **kw):
    data, _ = ml_data(spark, d, kind)
    return classify.fit_and_score(data, classify.estimator(name, **kw))


@query("nb_mllib")
def q_nb_mllib(spark, d):
    pred = classify.nb_split_predictions(classify.train_test_split(toks(spark, d)))
    return evaluate.classification_metrics(pred, by=["split"])


@query("random_forest")
def q_random_forest(spark, d):
    return ml_metrics(spark, d, "rf")


@query("ovr_logistic")
def q_ovr_logistic(spark, d):
    return ml_metrics(spark, d, "ovr_lr", kind="tfidf")


@query("ovr_svc")
def q_ovr_svc(spark, d):
    return ml_metrics(spark, d, "ovr_svc", kind="tfidf")


@query("gbt_classifier")
def q_gbt_classifier(spark, d):
    data, _ = ml_data(spark, d)
    head = columns.train_head_n(data, 1000).select("id")  # the reference boosts on the first n training rows
    train = data.join(head, "id", "left_semi")
    sub = classify.used_features(train.unionByName(data.filter(F.col("split") == "test")), train)
    return classify.fit_and_score(sub, classify.estimator("ovr_gbt"))


def samme_run(spark, d):
    data, labels = classify.labelled_bags(classify.train_test_split(toks(spark, d)))
    train = data.filter(F.col("split") == "train")
    trees, alphas = classify.adaboost_samme(train, n_rounds=20, learning_rate=1.0, max_depth=1,
                                            n_classes=len(labels))
    return data, labels, trees, alphas


@query("adaboost")
def q_adaboost(spark, d):
    data, labels, trees, alphas = samme_run(spark, d)
    pred = classify.adaboost_predict(data, trees, alphas, len(labels)).join(data.select("id", "split"), "id")
    return evaluate.classification_metrics(pred, by=["split"])


@query("staged_error")
def q_staged_error(spark, d):
    data, labels, trees, alphas = samme_run(spark, d)
    scores = materialize(boosting.samme_scores(data, trees, alphas, len(labels)), "score_table")
    return boosting.staged_error(scores, len(labels))


@query("staged_error_scores")
def q_staged_error_scores(spark, d):
    """Errors by round from a long score table: each number of a vector is what one round adds to one of ten classes."""
    emb = classify.train_test_split(V.table(spark, d, "embeddings"), "vec_id")
    long = emb.select(F.col("vec_id").alias("id"), "split", F.col("label").cast("double").alias("label"), F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
    cells = F.array(*[F.when(F.col("pos") % 10 == c, F.col("x")).otherwise(0.0) for c in range(10)])
    scores = long.select("id", "split", "label", (F.col("pos") + 1).cast("bigint").alias("round"), cells.alias("contributions"))
    return boosting.staged_error(scores, 10)


@query("rf_gridsearch")
def q_rf_gridsearch(spark, d):
    return tuning.forest_grid(tree_rows(spark, d))[0]


@query("gbt_gridsearch")
def q_gbt_gridsearch(spark, d):
    rows = classify.train_test_split(toks(spark, d)).where("split = 'train'")
    rows = evaluate.kfold_assign(columns.thread_label_encode(rows, out="y"), 5, 42).withColumn("y", F.col("y").cast("double"))
    binned = materialize(tuning.binned_counts(rows, keep=("id", "y", "fold")), "boosted_rows")
    return tuning.boosted_grid(binned)[0].drop("point")


def tree_rows(spark, d):
    """(id, label, split, features): hashed term counts with the thread's number as label."""
    lab = classify.train_test_split(toks(spark, d))
    coded = columns.thread_label_encode(lab, out="label").withColumn("label", F.col("label").cast("double"))
    return tuning.hashed_counts(coded, dims=512).select("id", "label", "split", "features")


def tagged_posts(spark, d):
    """(posts (id, split, tokens), pairs (id, tag) of posts and the known tags among their tokens)."""
    p = posts(spark, d)
    tk = V.post_tokens(p)
    pairs = materialize(features.tags_in_post(tk, profile.tag_counts(p)), "post_tags")
    return classify.train_test_split(tk).select("id", "split", "tokens"), pairs


@query("multilabel_tags")
def q_multilabel_tags(spark, d):
    return multilabel.multilabel_svc(*tagged_posts(spark, d))


@query("multilabel_nb")
def q_multilabel_nb(spark, d):
    return multilabel.multilabel_nb(*tagged_posts(spark, d), splits=("test",))


@query("saved_pipeline")
def q_saved_pipeline(spark, d):
    """Tokens and naive Bayes as one pipeline: fitted, saved, loaded again, applied to all posts."""
    from pyspark.ml import Pipeline as Stages
    from pyspark.ml import PipelineModel

    from tagloom.plans.stages import PostTokens, TermBayes

    p = classify.train_test_split(posts(spark, d))
    path = scratch_path(spark, "saved_pipeline")
    Stages(stages=[PostTokens(), TermBayes()]).fit(p.where("split = 'train'")).save(path)
    return PipelineModel.load(path).transform(p).select("id", "split", "thread", "prediction")


@query("nb_gridsearch")
def q_nb_gridsearch(spark, d):
    lab = evaluate.kfold_assign(labelled(spark, d).filter(F.col("split") == "train"), 5, 42)
    return classify.nb_grid_kfold(bow_table(spark, d), lab.select("id", "label", "fold"), k=5)


@query("pipeline_facade")
def q_pipeline_facade(spark, d):
    from tagloom.plans.pipeline import Pipeline

    lex = lexicons(spark, d)
    pipe = Pipeline(spark, "facade", root=scratch_path(spark, "pipelines"))
    pipe.preprocess(posts(spark, d), stop_words=lex["stop"], entities=lex["ent"], lemmas=lex["lem"])
    return pipe.featurize("bow", "thread").model("nb").evaluate(k=5)


# ------------------------------------------------------------------ streaming form of D1
@query("stream_token_counts")
def q_stream_token_counts(spark, d):
    from tagloom.streaming.corpus_stream import run_token_counts

    return run_token_counts(spark, d, glob="documents.parquet").select("term", "count")


@query("model_suite")
def q_model_suite(spark, d):
    from tagloom.plans.suite import model_suite

    return model_suite(toks(spark, d))
