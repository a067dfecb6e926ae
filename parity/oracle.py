"""SQL counterparts of the registered queries, written as plain relational rules.

They share constants with the engine only where both sides state the same input (derived
texts, the lexicon rows); the rules themselves are spelled out anew: recursive chunking,
positions and running maxima for dialog, rank() for Zipf, a join for tag shares.
"""

from __future__ import annotations

from lexiloom.functions.lexicon import builtin_rows, suffix_pattern, suffix_rows

ORACLE: dict[str, str] = {}

BLANK = (
    r"\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}"
)
JAVA_SPACE = r"[ \t\n\v\f\r]"
TOKEN = (
    r"[\p{L}\p{M}]+(?:[''’-][\p{L}\p{M}]+)*|\p{Nd}+(?:[.,]\p{Nd}+)*|\.\.\.|--|"
    rf"[^\p{{L}}\p{{M}}\p{{Nd}}{BLANK}]"
)


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# --- documents --------------------------------------------------------------------------

DOCS = """
docs AS (
  SELECT source AS author, CAST(doc_id AS VARCHAR) AS document_id, lang AS language,
         text AS raw_text
  FROM documents)"""

ERAS = """
eras AS (
  SELECT 'src' || i AS author, CASE WHEN i < 10 THEN 'romantic' ELSE 'realist' END AS era,
         'Source ' || i AS author_label
  FROM range(20) t(i))"""


def _stripped(source: str) -> str:
    return rf"""
unixed AS (
  SELECT author, document_id, language,
         regexp_replace(coalesce(raw_text, ''), '\r\n?', E'\n', 'g') AS t FROM {source}),
headless AS (
  SELECT author, document_id, language, regexp_replace(t,
    '(?is)\A.*?\*\*\*[{BLANK}]*START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*',
    '') AS t FROM unixed),
bodies AS (
  SELECT author, document_id, language, regexp_replace(t,
    '(?is)\*\*\*[{BLANK}]*END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK.*?\*\*\*.*\z',
    '') AS t FROM headless),
stripped AS (
  SELECT author, document_id, language, regexp_replace(
    regexp_replace(t, '\A[{BLANK}]+', ''), '[{BLANK}]+\z', '') AS raw_text FROM bodies)"""


def _cleaned(source: str) -> str:
    return rf"""
clean AS (
  SELECT author, document_id, language, trim(regexp_replace(regexp_replace(regexp_replace(
    coalesce(raw_text, ''), '\r\n?', E'\n', 'g'), '\n{{2,}}', E'\n\n', 'g'), '[ \t]+', ' ',
    'g')) AS text_clean
  FROM {source}),
split AS (
  SELECT *, CASE WHEN length(trim(text_clean)) = 0 THEN CAST([] AS VARCHAR[])
    ELSE string_split(regexp_replace(text_clean, '([.!?]){JAVA_SPACE}+', '\1' || chr(1),
    'g'), chr(1)) END AS sentences
  FROM clean),
stats AS (
  SELECT *, CAST(length(text_clean) AS INTEGER) AS char_count,
    CAST(CASE WHEN length(trim(text_clean)) = 0 THEN 0
      ELSE len(regexp_extract_all(text_clean, '{JAVA_SPACE}+')) + 1 END AS INTEGER)
      AS word_count,
    CAST(len(sentences) AS INTEGER) AS sentence_count
  FROM split),
clean_docs AS (
  SELECT *, CASE WHEN sentence_count = 0 THEN 0e0
    ELSE CAST(word_count AS DOUBLE) / CAST(sentence_count AS DOUBLE) END
    AS avg_words_per_sentence
  FROM stats)"""


CLEAN = [DOCS, _stripped("docs"), _cleaned("stripped")]

ORACLE["corpus_ingest_enrich"] = (
    _with(DOCS, ERAS)
    + """
SELECT d.author, d.document_id, CAST(length(d.raw_text) AS INTEGER) AS raw_chars,
       CASE WHEN d.language <> 'en' THEN d.language ELSE 'en' END AS language, e.era
FROM docs d JOIN eras e ON d.author = e.author"""
)

MARKED = r"""
marked AS (
  SELECT author, document_id, language, CASE CAST(document_id AS BIGINT) % 5
    WHEN 0 THEN head || raw_text || tail
    WHEN 1 THEN head || raw_text
    WHEN 2 THEN raw_text || tail
    WHEN 3 THEN lower(head) || raw_text || replace(tail, 'THE', 'THIS')
    ELSE raw_text END AS raw_text
  FROM (SELECT *,
    E'licence\r\n*** START OF THE PROJECT GUTENBERG EBOOK ' || document_id || E' ***\r\n'
      AS head,
    E'\r\n*** END OF THE PROJECT GUTENBERG EBOOK ' || document_id ||
      E' ***\r\nmore licence' AS tail
    FROM docs))"""

ORACLE["strip_boilerplate"] = (
    _with(DOCS, MARKED, _stripped("marked"))
    + "SELECT author, document_id, raw_text FROM stripped"
)

SPACED = r"""
spaced AS (
  SELECT author, document_id, language,
    replace(replace(raw_text, '. ', E'.  \t'), E'\n', E'\r\n\n\r') AS raw_text FROM docs)"""

ORACLE["clean_stats"] = (
    _with(DOCS, SPACED, _cleaned("spaced"))
    + """
SELECT author, document_id, language, text_clean, char_count, word_count, sentence_count,
       avg_words_per_sentence FROM clean_docs"""
)

ORACLE["sentence_split"] = (
    _with(*CLEAN)
    + """
SELECT author, document_id, CAST(unnest(range(len(sentences))) AS INTEGER) AS sentence_id,
       unnest(sentences) AS sentence FROM clean_docs"""
)

ORACLE["clean_top_words"] = (
    _with(*CLEAN, ERAS)
    + """
SELECT c.author, document_id, language, era, char_count, word_count, sentence_count,
       avg_words_per_sentence
FROM clean_docs c LEFT JOIN eras e ON c.author = e.author
ORDER BY word_count DESC, c.author, document_id LIMIT 100"""
)

# --- files ------------------------------------------------------------------------------

FILES = """
files AS (
  SELECT source AS author, CAST(doc_id AS VARCHAR) AS document_id, text,
         octet_length(encode(text)) AS bytes, true AS valid FROM documents
  UNION ALL
  SELECT 'web', CAST(page_id AS VARCHAR), html, octet_length(encode(html)), true FROM pages
  UNION ALL
  SELECT 'chat', conv_id || '_' || turn, text, octet_length(encode(text)) + 1, false
  FROM conversations),
manifest AS (
  SELECT author, document_id FROM files
  UNION ALL
  SELECT 'benchmark', CAST(item_id AS VARCHAR) FROM benchmark)"""

JUDGED = rf"""
judged AS (
  SELECT author, document_id,
    CASE WHEN strpos(text, '<!DOCTYPE') > 0 AND octet_length(encode(substr(text, 1,
           strpos(text, '<!DOCTYPE') - 1))) + 9 <= 200 THEN 'HTML_ERR'
         WHEN strpos(text, '<html') > 0 AND octet_length(encode(substr(text, 1,
           strpos(text, '<html') - 1))) + 5 <= 200 THEN 'HTML_ERR'
         WHEN NOT valid THEN 'ENCODING' ELSE 'ok' END AS verdict,
    bytes // 1024 AS kb,
    len(regexp_extract_all(text, '[^{BLANK}]+')) AS words
  FROM files)"""

ORACLE["corpus_validation"] = (
    _with(FILES, JUDGED)
    + """
SELECT m.author, m.document_id, coalesce(verdict, 'MISSING') AS status,
  CASE WHEN verdict IN ('ok', 'HTML_ERR') THEN CAST(kb AS BIGINT) END AS size_kb,
  CASE WHEN verdict = 'ok' THEN CAST(words AS INTEGER) END AS word_count
FROM manifest m LEFT JOIN judged j
  ON m.author = j.author AND m.document_id = j.document_id"""
)

ORACLE["manifest_missing"] = (
    _with(FILES)
    + """
SELECT author, document_id FROM manifest m WHERE NOT EXISTS (
  SELECT 1 FROM files f WHERE f.author = m.author AND f.document_id = m.document_id)"""
)

for _fmt in ("parquet", "orc", "csv", "json"):
    ORACLE[f"format_roundtrip_{_fmt}"] = (
        _with(DOCS) + "SELECT author, document_id, language, raw_text FROM docs"
    )

# --- chunks -----------------------------------------------------------------------------


def _chunks(max_chars: int) -> list[str]:
    """Greedy packing: from a chunk's first word, the first word that overflows starts the next."""
    return [
        *CLEAN,
        rf"""
word_lists AS MATERIALIZED (
  SELECT author, document_id, language, string_split(packed, ' ') AS words
  FROM (SELECT *, trim(regexp_replace(text_clean, '[{BLANK}]+', ' ', 'g')) AS packed
        FROM clean_docs)
  WHERE packed <> ''),
lengths AS (
  SELECT author, document_id, unnest(range(1, len(words) + 1)) AS i,
         length(unnest(words)) AS len FROM word_lists),
charged AS MATERIALIZED (
  SELECT *, sum(len + 1) OVER (PARTITION BY author, document_id ORDER BY i) AS cum
  FROM lengths),
starts AS (
  SELECT author, document_id, 0 AS chunk_id, CAST(1 AS BIGINT) AS first_word,
         CAST(0 AS HUGEINT) AS base FROM word_lists
  UNION ALL
  SELECT author, document_id, chunk_id + 1, nxt.i, nxt.base
  FROM (
    SELECT s.author, s.document_id, s.chunk_id,
           arg_min({{'i': c.i, 'base': c.cum - c.len}}, c.i) AS nxt
    FROM starts s JOIN charged c ON c.author = s.author AND c.document_id = s.document_id
      AND c.i > s.first_word AND c.cum - s.base > {max_chars}
    GROUP BY s.author, s.document_id, s.chunk_id)),
bounds AS (
  SELECT *, lead(first_word) OVER (PARTITION BY author, document_id ORDER BY chunk_id)
    AS next_word FROM starts),
chunks AS (
  SELECT b.author, b.document_id, w.language, CAST(b.chunk_id AS INTEGER) AS chunk_id,
    array_to_string(words[first_word:coalesce(next_word - 1, len(words))], ' ')
      AS text_clean
  FROM bounds b JOIN word_lists w ON b.author = w.author
    AND b.document_id = w.document_id)""",
    ]


CHUNKS = _chunks(4000)
SMALL_CHUNKS = _chunks(300)

ORACLE["chunk_corpus"] = (
    _with(*CHUNKS)
    + """
SELECT author, document_id, language, chunk_id, text_clean,
       CAST(length(text_clean) AS INTEGER) AS chunk_chars FROM chunks"""
)

ORACLE["chunk_plan"] = (
    _with(*SMALL_CHUNKS)
    + """
SELECT language, author, document_id, count(*) AS chunk_count FROM chunks
GROUP BY ALL"""
)

# --- tokens -----------------------------------------------------------------------------

WORDS = rf"""
words AS (
  SELECT author, document_id, language, chunk_id,
         CAST(unnest(range(len(list))) AS INTEGER) AS token_id,
         unnest(list) AS token, unnest(list_prepend(NULL, list[:-2])) AS previous
  FROM (SELECT *, regexp_extract_all(text_clean, '{TOKEN}') AS list FROM chunks)
  WHERE len(list) > 0)"""


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


LEXICON = f"""
lexicon(language, form, lemma, pos) AS (VALUES {_values(builtin_rows())}),
suffixes(language, suffix, pos, cut, ending) AS (VALUES {_values(suffix_rows())})"""

TAGGED = rf"""
marks AS (
  SELECT w.*, lower(token) AS low,
    regexp_extract(lower(token), CASE WHEN language = 'fr' THEN '{suffix_pattern("fr")}'
      ELSE '{suffix_pattern("en")}' END, 1) AS suffix,
    regexp_matches(token, '^\p{{Lu}}') AND previous IS NOT NULL AND previous NOT IN
      ('.', '!', '?', '…', '...', '?!', '!?', '«', '»', '“', '”', '"', '—', '–', '-', '--')
      AS name
  FROM words w WHERE w.language IN ('fr', 'en')),
tagged AS (
  SELECT m.*, l.lemma AS known_lemma, s.cut, s.ending,
    CASE WHEN l.pos IS NOT NULL THEN 'lexicon'
      WHEN regexp_matches(token, '^\p{{Nd}}') THEN 'number'
      WHEN NOT regexp_matches(token, '^[\p{{L}}\p{{M}}]')
        THEN CASE WHEN m.language = 'fr' AND regexp_matches(token, '^\p{{P}}')
          THEN 'mark' ELSE 'symbol' END
      WHEN name THEN 'name' WHEN s.pos IS NOT NULL THEN 'suffix' ELSE 'other' END AS why,
    CASE why WHEN 'lexicon' THEN l.pos
      WHEN 'number' THEN CASE m.language WHEN 'fr' THEN 'NUM' ELSE 'CD' END
      WHEN 'mark' THEN 'PUNCT' WHEN 'symbol' THEN 'SYM'
      WHEN 'name' THEN CASE m.language WHEN 'fr' THEN 'PROPN' ELSE 'NNP' END
      WHEN 'suffix' THEN s.pos
      ELSE CASE m.language WHEN 'fr' THEN 'NOUN' ELSE 'NN' END END AS pos
  FROM marks m LEFT JOIN lexicon l ON l.language = m.language AND l.form = m.low
  LEFT JOIN suffixes s ON s.language = m.language AND s.suffix = m.suffix),
tokens AS (
  SELECT author, document_id, language, chunk_id, token_id, token, pos,
    CASE why WHEN 'lexicon' THEN known_lemma
      WHEN 'suffix' THEN low[:length(low) - cut] || ending ELSE low END AS lemma,
    CASE WHEN pos IN ('PROPN', 'NNP', 'NNPS') THEN 'ENT' ELSE 'O' END AS ner
  FROM tagged)"""

TOKENS = [*CHUNKS, WORDS, LEXICON, TAGGED]
SMALL_TOKENS = [*SMALL_CHUNKS, WORDS, LEXICON, TAGGED]

TOKEN_ROW = "author, document_id, language, chunk_id, token_id, token, lemma, pos, ner"

ORACLE["tokenize"] = (
    _with(*CHUNKS, WORDS)
    + "SELECT document_id, author, language, chunk_id, token_id, token FROM words"
)
ORACLE["annotate_tokens"] = _with(*TOKENS) + f"SELECT {TOKEN_ROW} FROM tokens"
ORACLE["explode_annotations"] = (
    _with(*CHUNKS, WORDS)
    + r"""
SELECT author, document_id, language, chunk_id, token_id, token, lower(token) AS lemma,
  CASE WHEN regexp_matches(token, '^\p{Lu}') THEN 'PROPN' ELSE 'NOUN' END AS pos,
  CASE WHEN regexp_matches(token, '^\p{Lu}') THEN 'ENT' ELSE 'O' END AS ner
FROM words"""
)
LEXICON_ENTRIES = """
forms AS (SELECT DISTINCT language, lower(token) AS form, pos FROM tokens WHERE length(lower(token)) >= 5),
entries AS (
  SELECT language, form, form || '/own' || pos AS lemma, pos FROM forms WHERE length(form) = 5 OR length(form) > 8
  UNION ALL SELECT language, form, form || '/any', NULL FROM forms WHERE length(form) = 6 OR length(form) > 8
  UNION ALL SELECT language, form, form || '/one', 'OTHER' FROM forms WHERE length(form) IN (7, 8)
  UNION ALL SELECT language, form, form || '/two', 'OTHER' FROM forms WHERE length(form) = 7),
by_tag AS (SELECT language, form, pos, min(lemma) AS lemma FROM entries GROUP BY ALL),
by_form AS (
  SELECT language, form, min(lemma) FILTER (pos IS NULL) AS any_tag,
    CASE WHEN count(DISTINCT lemma) = 1 THEN min(lemma) END AS only_one
  FROM entries GROUP BY ALL)"""
ORACLE["lexicon_lemmas"] = _with(*TOKENS, LEXICON_ENTRIES) + """
SELECT author, document_id, t.language, chunk_id, token_id, token, t.pos, ner,
  coalesce(g.lemma, f.any_tag, f.only_one, t.lemma) AS lemma
FROM tokens t
LEFT JOIN by_tag g ON g.language = t.language AND g.form = lower(token) AND g.pos = t.pos
LEFT JOIN by_form f ON f.language = t.language AND f.form = lower(token)"""
SENTENCES = r"""
around AS (
  SELECT *, lead(token) OVER w AS following, lead(token, 2) OVER w AS second
  FROM words WINDOW w AS (PARTITION BY author, document_id, chunk_id ORDER BY token_id)),
stops AS (
  SELECT language, lower(token) AS form, count(*) AS n,
    count(*) FILTER (following = '.') AS n_stop,
    count(*) FILTER (following = '.' AND regexp_matches(second, '^\p{Lu}')) AS n_capital
  FROM around WHERE regexp_matches(token, '^[\p{L}\p{M}]') GROUP BY ALL),
shares AS (SELECT language, sum(n_stop) / sum(n) AS p FROM stops GROUP BY language),
scored AS (
  SELECT s.*,
    2 * (n_stop * ln(0.99) + (n - n_stop) * ln(0.01) - n_stop * ln(p)
      - (n - n_stop) * ln(greatest(1 - p, 1e-9)))
      * exp(-length(form) - (n - n_stop) * ln(length(form))) AS score
  FROM stops s JOIN shares USING (language) WHERE n_stop > 0),
short AS (
  SELECT language AS of, form, 2 * n_capital >= n_stop AS capital
  FROM scored WHERE n >= 5 AND score >= 0.3),
ends AS (
  SELECT a.*, CASE WHEN token NOT IN ('.', '!', '?', '…', '...', '?!', '!?') THEN 0
    WHEN form IS NULL THEN 1
    WHEN capital OR following IS NULL OR NOT regexp_matches(following, '^\p{Lu}') THEN 0
    ELSE 1 END AS is_end
  FROM around a LEFT JOIN short s
    ON s.of = a.language AND s.form = lower(a.previous) AND a.token = '.'),
sentence_rows AS (
  SELECT author, document_id, chunk_id, language, token_id, token, previous,
    CAST(coalesce(sum(is_end) OVER (PARTITION BY author, document_id
      ORDER BY chunk_id, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS BIGINT) AS sentence_id
  FROM ends)"""

ORACLE["abbreviation_scores"] = _with(*CHUNKS, WORDS, SENTENCES) + """
SELECT language, form, n, n_stop, n_capital, round(score, 6) AS score FROM scored"""
ORACLE["sentence_tokens"] = _with(*CHUNKS, WORDS, SENTENCES) + "SELECT * FROM sentence_rows"
ORACLE["tag_transitions"] = _with(*TOKENS, SENTENCES) + """
SELECT language, previous, pos, count(*) AS n FROM (
  SELECT language, pos, coalesce(lag(pos) OVER (
    PARTITION BY author, document_id, chunk_id, sentence_id ORDER BY token_id), '<s>') AS previous
  FROM (SELECT s.author, s.document_id, s.chunk_id, s.sentence_id, s.token_id, s.language, t.pos
    FROM sentence_rows s JOIN tokens t USING (author, document_id, chunk_id, token_id)))
GROUP BY ALL"""
ORACLE["tag_emissions"] = _with(*TOKENS) + r"""
SELECT language, lower(token) AS form, pos, count(*) AS n,
  CASE WHEN regexp_matches(token, '^\p{Lu}') THEN 'A' WHEN regexp_matches(token, '^[\p{L}\p{M}]') THEN 'a'
    WHEN regexp_matches(token, '^\p{Nd}') THEN '0' ELSE '.' END AS shape
FROM tokens GROUP BY ALL"""
ORACLE["entity_flag"] = (
    _with(*TOKENS)
    + """
SELECT author, document_id, pos, ner, count(*) AS token_rows FROM tokens GROUP BY ALL"""
)
ORACLE["row_counts"] = (
    _with(*TOKENS)
    + """
SELECT 'documents' AS table_name, count(*) AS row_count FROM docs
UNION ALL SELECT 'tokens', count(*) FROM tokens"""
)
ORACLE["tokens_by_author"] = (
    _with(*TOKENS) + "SELECT author, count(*) AS token_rows FROM tokens GROUP BY author"
)
ORACLE["doc_filter"] = (
    _with(*TOKENS)
    + f"""
SELECT {TOKEN_ROW} FROM tokens WHERE (author, document_id) = (
  SELECT (source, CAST(doc_id AS VARCHAR)) FROM documents WHERE lang IN ('fr', 'en')
  ORDER BY n_chars DESC, doc_id DESC LIMIT 1)"""
)

# --- readability ------------------------------------------------------------------------

SYLLABLES = r"""
syl AS (
  SELECT *, CAST(CASE WHEN NOT regexp_matches(token, '[\p{L}\p{Nl}\p{No}_]') THEN 0
    WHEN language = 'fr' THEN greatest(1, len(regexp_extract_all(token,
      '[aeiouyàâäéèêëîïôùûüœæAEIOUYÀÂÄÉÈÊËÎÏÔÙÛÜŒÆİı]+')))
    ELSE greatest(1, len(regexp_extract_all(token, '[aeiouyAEIOUYİı]+'))) END AS INTEGER)
    AS syllables
  FROM tokens),
chunk_rows AS (
  SELECT author, document_id, language, chunk_id,
    CAST(sum(CASE WHEN pos IN ('PUNCT', 'SYM', 'X') OR syllables = 0 THEN 0 ELSE 1 END)
      AS BIGINT) AS word_count,
    CAST(sum(syllables) AS BIGINT) AS syllable_count,
    CAST(sum(CASE WHEN token IN ('.', '!', '?', '…', '...', '?!', '!?') THEN 1 ELSE 0 END)
      + 1 AS BIGINT) AS sentence_count
  FROM syl GROUP BY author, document_id, language, chunk_id)"""

SCORE = """
  CASE WHEN language = 'fr' THEN 207e0
      - 1.015e0 * (CAST(word_count AS DOUBLE) / greatest(CAST(sentence_count AS DOUBLE), 1e0))
      - 73.6e0 * (CAST(syllable_count AS DOUBLE) / greatest(CAST(word_count AS DOUBLE), 1e0))
    ELSE 0.39e0 * (CAST(word_count AS DOUBLE) / greatest(CAST(sentence_count AS DOUBLE), 1e0))
      + 11.8e0 * (CAST(syllable_count AS DOUBLE) / greatest(CAST(word_count AS DOUBLE), 1e0))
      - 15.59e0 END AS readability_score,
  CASE WHEN language = 'fr' THEN 'Kandel-Moles' ELSE 'Flesch-Kincaid Grade Level' END
    AS readability_index"""

GLOBAL = f"""
doc_rows AS (
  SELECT author, document_id, language, CAST(sum(word_count) AS BIGINT) AS word_count,
    CAST(sum(syllable_count) AS BIGINT) AS syllable_count,
    CAST(sum(sentence_count) AS BIGINT) AS sentence_count
  FROM chunk_rows GROUP BY author, document_id, language),
doc_scores AS (
  SELECT *, {SCORE},
    CAST(word_count AS DOUBLE) / greatest(sentence_count, 1) AS avg_sentence_length,
    CAST(syllable_count AS DOUBLE) / greatest(word_count, 1) AS avg_syllables_per_word
  FROM doc_rows)"""


def _frame(size: int) -> str:
    half = size // 2
    sums = ", ".join(
        f"CAST(sum({name}) OVER w AS BIGINT) AS {name}"
        for name in ("word_count", "syllable_count", "sentence_count")
    )
    return f"""
  SELECT author, document_id, language, chunk_id, {sums}, CAST({size} AS INTEGER)
    AS window_size
  FROM chunk_rows WINDOW w AS (PARTITION BY author, document_id ORDER BY chunk_id
    RANGE BETWEEN {half} PRECEDING AND {half} FOLLOWING)"""


SLIDING = f"""
frames AS ({" UNION ALL ".join(_frame(size) for size in (5, 10, 20))}),
sliding AS (SELECT *, {SCORE} FROM frames)"""

ORACLE["syllables"] = (
    _with(*TOKENS, SYLLABLES)
    + """
SELECT language, token, syllables, count(*) AS token_rows FROM syl GROUP BY ALL"""
)
ORACLE["chunk_stats"] = _with(*TOKENS, SYLLABLES) + "SELECT * FROM chunk_rows"
ORACLE["readability_global"] = (
    _with(*TOKENS, SYLLABLES, GLOBAL) + "SELECT * FROM doc_scores"
)
ORACLE["readability_report"] = (
    _with(*TOKENS, SYLLABLES, GLOBAL, ERAS)
    + """
SELECT author_label, document_id, language, readability_index,
  round_even(readability_score, 2) AS readability_score,
  round_even(avg_sentence_length, 2) AS avg_sentence_length,
  round_even(avg_syllables_per_word, 2) AS avg_syllables_per_word
FROM doc_scores d LEFT JOIN eras e ON d.author = e.author"""
)
ORACLE["readability_sliding"] = (
    _with(*SMALL_TOKENS, SYLLABLES, SLIDING) + "SELECT * FROM sliding"
)
ORACLE["sliding_series"] = (
    _with(*SMALL_TOKENS, SYLLABLES, SLIDING)
    + """
SELECT document_id, chunk_id, window_size || ' chunks' AS window_size_label,
  readability_score FROM sliding"""
)
ORACLE["sliding_selected"] = (
    "SELECT s.* FROM (" + ORACLE["sliding_series"].replace("SELECT document_id,", "SELECT author, document_id,") + """) s
JOIN (
  SELECT source, CAST(arg_max(doc_id, {'n': n_chars, 'd': doc_id}) AS VARCHAR) AS longest
  FROM documents WHERE lang IN ('fr', 'en') GROUP BY source) l
ON s.author = l.source AND s.document_id = l.longest"""
)
ORACLE["sliding_summary"] = (
    _with(*SMALL_TOKENS, SYLLABLES, SLIDING)
    + """
SELECT language, readability_index, window_size,
  round_even(avg(readability_score), 2) AS mean_score,
  round_even(stddev_samp(readability_score), 2) AS std_score,
  round_even(min(readability_score), 2) AS min_score,
  round_even(max(readability_score), 2) AS max_score
FROM sliding GROUP BY language, readability_index, window_size"""
)

# --- stylometry -------------------------------------------------------------------------


def _zipf(source: str = "tokens") -> str:
    return f"""
term_counts AS (
  SELECT author, document_id, language, lower(token) AS token, count(*) AS frequency
  FROM {source} WHERE pos NOT IN ('PUNCT', 'SYM', 'X')
  GROUP BY author, document_id, language, lower(token)),
ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY author, document_id ORDER BY frequency DESC)
    AS INTEGER) AS rank FROM term_counts),
zipf_rows AS (
  SELECT author, document_id, language, token, frequency, rank,
    round(ln(CAST(rank AS DOUBLE)), 6) AS log_rank,
    round(ln(CAST(frequency AS DOUBLE)), 6) AS log_frequency FROM ranked)"""


ORACLE["zipf"] = _with(*TOKENS, _zipf()) + "SELECT * FROM zipf_rows"
ORACLE["zipf_top500"] = (
    _with(*TOKENS, _zipf()) + "SELECT * FROM zipf_rows WHERE rank <= 500"
)
ORACLE["zipf_top20"] = (
    _with(*TOKENS, _zipf()) + "SELECT * FROM zipf_rows WHERE rank <= 20"
)
ORACLE["zipf_reps"] = (
    _with(
        *TOKENS,
        _zipf(),
        ERAS,
        """
reps AS (
  SELECT author, document_id FROM (
    SELECT source AS author, CAST(doc_id AS VARCHAR) AS document_id,
      row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS place
    FROM documents WHERE lang IN ('fr', 'en')) WHERE place = 1)""",
    )
    + """
SELECT z.*, e.era, e.author_label
FROM zipf_rows z JOIN reps r ON z.author = r.author AND z.document_id = r.document_id
LEFT JOIN eras e ON z.author = e.author
WHERE rank <= 500"""
)

TURNS = """
chunks AS (
  SELECT 'style' || conv_id % 10 AS author, CAST(conv_id AS VARCHAR) AS document_id,
    CASE WHEN (conv_id // 4) % 2 = 0 THEN 'en' ELSE 'fr' END AS language,
    CAST(turn AS INTEGER) AS chunk_id,
    CASE WHEN role <> 'user' THEN text
      WHEN conv_id % 10 = 0 THEN '« ' || text || ' »'
      WHEN conv_id % 10 = 1 THEN '“ ' || text || ' ”'
      WHEN conv_id % 10 = 2 THEN '" ' || text || ' "'
      WHEN conv_id % 10 = 3 THEN '— ' || text
      WHEN conv_id % 10 = 4 THEN '-- ' || text
      WHEN conv_id % 10 = 5 THEN '- - ' || text
      WHEN conv_id % 10 = 6 THEN ':--' || text
      WHEN conv_id % 10 = 7 THEN '– ' || text
      WHEN conv_id % 10 = 8 THEN '― ' || text
      ELSE '— “ ' || text || ' ”' END AS text_clean
  FROM conversations)"""

TALK = [TURNS, WORDS, LEXICON, TAGGED]

DIALOG = r"""
placed AS (
  SELECT *, row_number() OVER d AS place, lag(token) OVER d AS p1, lead(token) OVER d AS n1,
    lead(token, 2) OVER d AS n2, lead(token, 3) OVER d AS n3
  FROM tokens
  WINDOW d AS (PARTITION BY author, document_id ORDER BY chunk_id, token_id)),
signs AS (
  SELECT *,
    CAST(regexp_matches(token, '[«“]') AS INTEGER) AS opening,
    CAST(regexp_matches(token, '[»”]') AS INTEGER) AS closing,
    CAST(token = '"' OR regexp_matches(token, '^".|."$') AS INTEGER) AS straight,
    (p1 IS NULL OR p1 IN ('.', '!', '?', '…', '?!', '!?', ':', ';', '»', '”', '"')
      OR regexp_matches(token, '^[:;](?:--|—|–|-|―)'))
    AND (
      (token IN ('—', '–', '-', '―', '--', ':--', ':—', ':–', ':―')
        AND (coalesce(regexp_matches(n1, '[A-Za-zÀ-ÖØ-öø-ÿ]'), false)
          OR (coalesce(n1 IN ('«', '“', '»', '”', '"'), false)
            AND coalesce(regexp_matches(n2, '[A-Za-zÀ-ÖØ-öø-ÿ]'), false))))
      OR (token = '-' AND coalesce(n1 = '-', false)
        AND (coalesce(regexp_matches(n2, '[A-Za-zÀ-ÖØ-öø-ÿ]'), false)
          OR (coalesce(n2 IN ('«', '“', '»', '”', '"'), false)
            AND coalesce(regexp_matches(n3, '[A-Za-zÀ-ÖØ-öø-ÿ]'), false))))
      OR regexp_matches(token, '^[:;]?(?:--|—|–|-|―)[A-Za-zÀ-ÖØ-öø-ÿ]')) AS dash_start
  FROM placed),
running AS (
  SELECT *,
    sum(opening - closing) OVER c AS depth, sum(straight) OVER c AS straights,
    coalesce(max(CASE WHEN dash_start THEN place END) OVER d, -1) AS last_start,
    coalesce(max(CASE WHEN token IN ('.', '!', '?', '…', '?!', '!?') THEN place END) OVER d,
      -1) AS last_end
  FROM signs
  WINDOW c AS (PARTITION BY author, document_id, chunk_id ORDER BY token_id
           ROWS UNBOUNDED PRECEDING),
         d AS (PARTITION BY author, document_id ORDER BY chunk_id, token_id
           ROWS UNBOUNDED PRECEDING)),
segments AS (
  SELECT author, document_id, language, chunk_id, token_id, token, lemma, pos, ner,
    CASE WHEN depth > 0 OR depth - (opening - closing) > 0 OR straights % 2 = 1
      OR (straights - straight) % 2 = 1 OR last_start > last_end
      THEN 'dialog' ELSE 'narration' END AS segment
  FROM running),
dialog_rows AS (
  SELECT author, document_id, language, count(*) AS total_tokens,
    count(*) FILTER (segment = 'dialog') AS dialog_tokens,
    count(*) FILTER (segment = 'narration') AS narration_tokens,
    CAST(count(*) FILTER (segment = 'dialog') AS DOUBLE) / greatest(count(*), 1)
      AS dialog_ratio
  FROM segments GROUP BY author, document_id, language)"""

ORACLE["dialog_tokens"] = _with(*TALK, DIALOG) + "SELECT * FROM segments"
ORACLE["dialog_tokens_split"] = ORACLE["dialog_tokens"]
ORACLE["dialog_summary"] = _with(*TALK, DIALOG) + "SELECT * FROM dialog_rows"
ORACLE["dialog_report"] = (
    _with(*TOKENS, DIALOG, ERAS)
    + """
SELECT e.era, e.author_label, d.author, document_id, language, dialog_tokens, total_tokens,
  round_even(dialog_ratio, 3) AS dialog_ratio
FROM dialog_rows d LEFT JOIN eras e ON d.author = e.author"""
)

PUNCT = "'.', ',', ':', ';', '''''', '``', '-LRB-', '-RRB-', 'HYPH', 'NFP'"


def _ttr(excluded: str) -> str:
    return f"""
ttr_rows AS (
  SELECT author, document_id, language, count(*) AS total_tokens,
    count(DISTINCT lower(lemma)) AS unique_lemmas,
    CAST(count(DISTINCT lower(lemma)) AS DOUBLE) / greatest(count(*), 1) AS ttr
  FROM tokens WHERE pos NOT IN ({excluded})
  GROUP BY author, document_id, language)"""


TTR = _ttr("'PUNCT', 'SYM', 'X'")

ORACLE["ttr"] = _with(*TOKENS, TTR) + "SELECT * FROM ttr_rows"
ORACLE["ttr_normalised"] = (
    _with(*TOKENS, _ttr(f"'PUNCT', 'SYM', 'X', {PUNCT}")) + "SELECT * FROM ttr_rows"
)
ORACLE["ttr_by_era"] = (
    _with(*TOKENS, TTR, ERAS)
    + """
SELECT t.*, e.era, e.author_label FROM ttr_rows t JOIN eras e ON t.author = e.author"""
)
ORACLE["corpus_size"] = (
    _with(*TOKENS, TTR, ERAS)
    + """
SELECT e.era, e.author_label, t.author, document_id, language, total_tokens
FROM ttr_rows t LEFT JOIN eras e ON t.author = e.author"""
)

POS = f"""
normalised AS (
  SELECT *, CASE WHEN pos IN ('NN', 'NNS') THEN 'NOUN'
    WHEN pos IN ('NNP', 'NNPS') THEN 'PROPN'
    WHEN pos IN ('VB', 'VBD', 'VBG', 'VBN', 'VBP', 'VBZ') THEN 'VERB'
    WHEN pos IN ('JJ', 'JJR', 'JJS') THEN 'ADJ'
    WHEN pos IN ('RB', 'RBR', 'RBS') THEN 'ADV'
    WHEN pos IN ('DT', 'PDT', 'WDT') THEN 'DET'
    WHEN pos IN ({PUNCT}) THEN 'PUNCT' ELSE pos END AS pos_normalised
  FROM tokens),
totals AS (
  SELECT author, document_id, language, count(*) AS total_tokens FROM tokens
  GROUP BY author, document_id, language),
tag_counts AS (
  SELECT author, document_id, language, pos_normalised, count(*) AS token_count
  FROM normalised
  WHERE pos_normalised IN ('NOUN', 'VERB', 'ADJ', 'PROPN', 'ADV', 'DET', 'PUNCT')
  GROUP BY author, document_id, language, pos_normalised),
pos_rows AS (
  SELECT c.*, t.total_tokens,
    CAST(token_count AS DOUBLE) / greatest(total_tokens, 1) AS pos_ratio
  FROM tag_counts c LEFT JOIN totals t ON c.author = t.author
    AND c.document_id = t.document_id AND c.language = t.language)"""

POS_AUTHOR = """
author_rows AS (
  SELECT author_label, era, pos_normalised, CAST(sum(token_count) AS BIGINT) AS token_count,
    CAST(sum(total_tokens) AS BIGINT) AS total,
    CAST(sum(token_count) AS DOUBLE) / CAST(sum(total_tokens) AS DOUBLE) AS pos_ratio
  FROM pos_rows p JOIN eras e ON p.author = e.author
  GROUP BY author_label, era, pos_normalised)"""

ORACLE["pos_distribution"] = _with(*TOKENS, POS) + "SELECT * FROM pos_rows"
ORACLE["pos_by_author"] = (
    _with(*TOKENS, POS, ERAS, POS_AUTHOR) + "SELECT * FROM author_rows"
)
ORACLE["pos_pivot"] = (
    _with(*TOKENS, POS, ERAS, POS_AUTHOR)
    + "SELECT author_label, "
    + ", ".join(
        f"round_even(coalesce(avg(pos_ratio) FILTER (pos_normalised = '{tag}'), 0e0), 3) AS \"{tag}\""
        for tag in ("NOUN", "VERB", "ADJ", "PROPN", "ADV", "DET", "PUNCT")
    )
    + " FROM author_rows GROUP BY author_label"
)

# --- diagnostics ------------------------------------------------------------------------

QUOTES = """
quotes AS (SELECT * FROM tokens WHERE regexp_matches(token, '[«»“”"''—–-]'))"""

ORACLE["quote_counts_global"] = (
    _with(*TALK, QUOTES)
    + "SELECT token, count(*) AS occurrences FROM quotes GROUP BY token"
)
ORACLE["quote_counts_doc"] = (
    _with(*TALK, QUOTES)
    + """
SELECT author, document_id, token, count(*) AS occurrences FROM quotes
GROUP BY author, document_id, token"""
)
ORACLE["quote_samples"] = (
    _with(*TALK, QUOTES)
    + """
SELECT author, document_id, language, chunk_id, token_id, token, pos FROM quotes
ORDER BY author, document_id, chunk_id, token_id LIMIT 300"""
)

# --- files ------------------------------------------------------------------------------

ORACLE["storage_footprint_text"] = """
SELECT dataset, round_even(sum(n) / 1048576, 2) AS size_mb FROM (
  SELECT 'documents' AS dataset, octet_length(encode(text)) + 1 AS n FROM documents
  UNION ALL SELECT 'pages', octet_length(encode(html)) + 1 FROM pages
  UNION ALL SELECT 'conversations', octet_length(encode(text)) + 1 FROM conversations)
GROUP BY dataset"""
ORACLE["corpus_scan"] = """
SELECT source AS author, text || chr(10) AS raw_text FROM documents"""
ORACLE["job_corpus_tokens"] = (
    _with(*TOKENS)
    + """
SELECT '0' || replace(author, 'src', '') AS author, document_id, language, count(*) AS token_rows
FROM tokens GROUP BY ALL"""
)
ORACLE["job_updated_tokens"] = (
    _with(*TOKENS)
    + """
SELECT author, document_id, language, count(*) AS token_rows, CAST(sum(length(token)) AS BIGINT) AS token_chars
FROM tokens GROUP BY ALL"""
)
ORACLE["job_readability"] = ORACLE["readability_global"]
ORACLE["job_stylometry"] = (
    _with(*TOKENS, _zipf(), DIALOG, TTR, POS)
    + " UNION ALL ".join(
        f"""
SELECT author, document_id, count(*) AS n, CAST(sum({column}) AS BIGINT) AS total, '{name}' AS result
FROM {name}_rows GROUP BY ALL"""
        for name, column in (("zipf", "frequency"), ("dialog", "dialog_tokens"), ("ttr", "unique_lemmas"), ("pos", "token_count"))
    )
)
ORACLE["job_all"] = (
    _with(*TOKENS)
    + "SELECT concat_ws('-', author, language) AS author, count(*) AS token_rows FROM tokens GROUP BY 1"
)
ORACLE["lemma_sketches"] = (
    _with(*TOKENS)
    + """
SELECT author, count(*) AS total_tokens, count(DISTINCT lower(lemma)) AS unique_lemmas, true AS is_close
FROM tokens WHERE pos NOT IN ('PUNCT', 'SYM', 'X') GROUP BY author"""
)
LINE_FILES = """
files AS (
  SELECT source AS author, CAST(doc_id AS VARCHAR) AS document_id, text,
         octet_length(encode(text)) + 1 AS bytes, true AS valid FROM documents)"""
ORACLE["corpus_file_sizes"] = (
    _with(LINE_FILES, JUDGED)
    + """
SELECT author, verdict AS status, count(*) AS files, CAST(sum(kb) AS BIGINT) AS size_kb,
  CAST(sum(words) AS BIGINT) AS word_count
FROM judged GROUP BY ALL"""
)
