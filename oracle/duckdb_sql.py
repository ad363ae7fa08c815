"""DuckDB SQL for the correctness check: the same questions as the Spark queries, written independently in SQL
over the pre-registered tables. Fragments below build the shared derived views (posts, lexicons, word space)."""

from __future__ import annotations

# ---- fixed values (same patterns as tagloom.functions.text) ----
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"
WS_RUN = r"[\t\n\x0B\f\r ]+"
NON_WORD = r"[^\p{L}\p{N}_\t\n\x0B\f\r ]"
HTML_BLOCKS = r"(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>"
HTML_TAG = r"<[^>]*>"
HTML_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"),
            ("&middot;", "·"), ("&amp;", "&")]


def tok(x: str, min_len: int = 2) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '{TOKEN_SPLIT}'), lambda t: length(t) >= {min_len})"


def ws_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_RUN}'), lambda t: t <> '')"


def punct(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{NON_WORD}', ' ', 'g'), '{WS_RUN}', ' ', 'g')"


def delims(x: str) -> str:
    return f"regexp_replace({x}, '[\\[\\]\"'',]', ' ', 'g')"


def repair(x: str) -> str:
    controls = "".join(chr(ch.encode("cp1252")[0]) for ch in CP1252)
    cont = f"[\x80-\xBF{CP1252}]"
    seq = f"(?:[\xC2-\xDF]{cont}|[\xE0-\xEF]{cont}{{2}}|[\xF0-\xF4]{cont}{{3}})"
    raw = ("unhex(array_to_string(list_transform(string_split(translate(p, '" + CP1252 + "', '" + controls
           + "'), ''), lambda c: printf('%02x', unicode(c))), ''))")
    mend = f"CASE WHEN regexp_full_match(p, '{seq}+') THEN coalesce(try(decode({raw})), p) ELSE p END"
    return (f"CASE WHEN regexp_matches({x}, '{seq}') THEN array_to_string(list_transform(regexp_extract_all({x}, "
            f"'{seq}+|[^\xC2-\xF4]+|[\xC2-\xF4]'), lambda p: {mend}), '') ELSE {x} END")


def unescape(x: str) -> str:
    out = x
    for ent, ch in ENTITIES:
        out = f"replace({out}, '{ent}', '{ch}')"
    return out


def strip_html(x: str) -> str:
    t = f"regexp_replace({x}, '{HTML_BLOCKS}', ' ', 'g')"
    t = f"regexp_replace({t}, '{HTML_TAG}', ' ', 'g')"
    return f"trim(regexp_replace({unescape(t)}, '{WS_RUN}', ' ', 'g'))"


def clean_text(x: str) -> str:
    return ws_tokens(punct(delims(repair(x))))


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, ' '), '')"


def bucket(x: str, k: int, seed=None) -> str:
    key = f"cast({x} AS VARCHAR)" if seed is None else f"('{seed}|' || cast({x} AS VARCHAR))"
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % {k})"


POSTS = f"""posts AS (
  SELECT doc_id AS id, lang AS thread,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS content,
         list_sort(list_distinct(list_filter({tok("split_part(text, chr(10), 1)")}, lambda t: length(t) >= 5))) AS tags
  FROM documents)"""

TOKS = f"""toks AS (SELECT id, thread, {tok("concat_ws(chr(10), title, content)")} AS tokens FROM posts)"""

COUNTS = """counts AS (SELECT term, count(*)::BIGINT AS count FROM (SELECT unnest(tokens) AS term FROM toks) GROUP BY term)"""

RANKED = """ranked AS (SELECT term, count, row_number() OVER (ORDER BY count DESC, term) AS rank FROM counts)"""

LEXICONS = """stop AS (SELECT term AS word FROM ranked WHERE rank <= 20),
ent AS (SELECT term AS phrase, CASE rank % 3 WHEN 0 THEN 'ORG' WHEN 1 THEN 'DATE' ELSE 'GPE' END AS type
        FROM ranked WHERE rank BETWEEN 21 AND 70),
lem AS (SELECT term AS form, CASE WHEN rank % 2 = 0 THEN 'noun' ELSE 'verb' END AS pos,
               substr(term, 1, length(term) - 1) AS lemma
        FROM ranked WHERE rank BETWEEN 71 AND 270 AND length(term) >= 5),
poslex AS (SELECT term AS token, ['NOUN','VERB','ADJ','ADV'][""" + bucket("term", 4) + """ + 1] AS pos
           FROM ranked WHERE rank <= 500)"""

BASE = f"WITH {POSTS},\n{TOKS},\n{COUNTS},\n{RANKED},\n{LEXICONS}"


def with_views(body: str) -> str:
    return f"{BASE}\n{body}"


def token_steps(src: str, ner: bool, stop: bool, lemma: bool, prefix: str = "") -> str:
    """Long-form token steps over CTE ``src`` (id, pos, tok) -> CTE chain ending in ``{prefix}steps_out``."""
    parts = []
    cur = src
    if ner:
        parts.append(f"""{prefix}s_ner AS (SELECT l.id, l.pos, CASE WHEN e.phrase IS NOT NULL THEN upper(l.tok) ELSE lower(l.tok) END AS tok
  FROM {cur} l LEFT JOIN (SELECT DISTINCT phrase FROM ent WHERE type <> 'DATE') e ON lower(l.tok) = e.phrase)""")
        cur = f"{prefix}s_ner"
    if stop:
        parts.append(f"""{prefix}s_stop AS (SELECT l.id, l.pos, CASE WHEN s.word IS NULL THEN l.tok END AS tok
  FROM {cur} l LEFT JOIN (SELECT DISTINCT word FROM stop) s ON l.tok = s.word)""")
        cur = f"{prefix}s_stop"
    if lemma:
        parts.append(f"""{prefix}s_noun AS (SELECT l.id, l.pos, coalesce(x.lemma, l.tok) AS tok
  FROM {cur} l LEFT JOIN (SELECT form, lemma FROM lem WHERE pos = 'noun') x ON l.tok = x.form)""")
        parts.append(f"""{prefix}s_verb AS (SELECT l.id, l.pos, coalesce(x.lemma, l.tok) AS tok
  FROM {prefix}s_noun l LEFT JOIN (SELECT form, lemma FROM lem WHERE pos = 'verb') x ON l.tok = x.form)""")
        cur = f"{prefix}s_verb"
    parts.append(f"{prefix}steps_out AS (SELECT * FROM {cur})")
    return ",\n".join(parts)


def rebuilt(ids_cte: str, long_cte: str, out: str = "tokens") -> str:
    """Ordered per-document list, keeping documents with no token."""
    return f"""(SELECT i.id, coalesce(r.lst, []) AS {out} FROM {ids_cte} i LEFT JOIN
   (SELECT id, list(tok ORDER BY pos) FILTER (WHERE tok IS NOT NULL) AS lst FROM {long_cte} GROUP BY id) r
   ON i.id = r.id)"""
