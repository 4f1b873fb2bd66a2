"""DuckDB SQL that states the result of each registered query independently."""

from __future__ import annotations

from gleaner.config import CurationConfig, QualityFilters
from gleaner.functions.template import CHATML, HEADER, ROLE_TAG, ChatTemplate
from gleaner.functions.tokens import UNSPACED
from gleaner.operators.features import GRAM_BASE, GRAM_MODULUS
from gleaner.plans.catalog import (
    BASE,
    CHARACTERS,
    DOCUMENT_THRESHOLD,
    EXTRA_PHRASES,
    INSTRUCT,
    MOST_SIMILAR,
    OPTIMIZED,
    PERPLEXITY_BAND,
    PLANES,
    REFUSING,
    RUN,
    SPARSE_THRESHOLD,
    TOKEN_BUDGET,
    TOP_K,
    VECTOR_THRESHOLD,
    WIDE,
)

UNSPACED_LETTERS = "".join(rf"\p{{{name}}}" for name in UNSPACED)
PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r ]"


def text(value: str) -> str:
    """A string as a SQL expression."""
    pieces = ["'" + p.replace("'", "''") + "'" for p in value.split("\n")]
    return "(" + " || chr(10) || ".join(pieces) + ")"


def words(column: str) -> str:
    """A letter of an unspaced script is set apart by spaces, which are no tokens."""
    spaced = f"regexp_replace(coalesce({column}, ''), '([{UNSPACED_LETTERS}])', ' \\1 ', 'g')"
    return f"regexp_extract_all({spaced}, '{PATTERN}')"


def n_tokens(column: str) -> str:
    return f"len({words(column)})"


def wrapped(template: ChatTemplate, role: str, content: str) -> str:
    return (
        f"({text(template.before_role)} || {role} || {text(template.after_role)} || {content}"
        f" || {text(template.after_content)})"
    )


def phrases(patterns) -> str:
    joined = "|".join(f"(?:{p})" for p in patterns).replace("'", "''")
    return f"'(?i){joined}'"


EXCHANGES = """
exchanges AS (
  SELECT q.conv_id, q.turn, q.text AS instruction, a.text AS output,
         CASE WHEN q.turn % 4 = 0 THEN '' WHEN q.turn % 4 = 2 THEN 'Turn ' || q.turn END AS input
  FROM conversations q JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND q.role = 'user' AND a.role = 'assistant'),
asked AS (
  SELECT *, CASE WHEN length(input) > 0 THEN instruction || chr(10) || input ELSE instruction END AS question
  FROM exchanges)"""


def refused_sql(filters: QualityFilters, role: str = "role", content: str = "text") -> str:
    if not filters.check_for_refusal:
        return "false"
    return f"({role} = 'assistant' AND regexp_matches({content}, {phrases(filters.refusal_patterns)}))"


def facts_sql(filters: QualityFilters, sum_mode: bool = False, special: int = 0) -> str:
    roles = ", ".join(f"'{r}'" for r in filters.must_have_roles)
    n = f"({n_tokens('text')} + {special if sum_mode else 0})"
    total = n if sum_mode else n_tokens(wrapped(CHATML, "role", "text"))
    return f"""
facts AS (
  SELECT conv_id, count(*) AS n_messages,
         arg_min(role = 'user', turn) AS starts_with_user,
         bool_and(role IN ({roles})) AS roles_allowed,
         sum({total})::BIGINT AS total_tokens,
         min({n})::BIGINT AS fewest_tokens, max({n})::BIGINT AS most_tokens,
         sum(CASE WHEN role = 'user' THEN {n} ELSE 0 END)::BIGINT AS user_tokens,
         sum(CASE WHEN role = 'assistant' THEN {n} ELSE 0 END)::BIGINT AS assistant_tokens,
         bool_or({refused_sql(filters)}) AS refused
  FROM conversations GROUP BY conv_id)"""


def passes_sql(f: QualityFilters) -> str:
    return f"""(n_messages // 2 BETWEEN {f.min_turns} AND {f.max_turns}
  AND starts_with_user AND roles_allowed
  AND total_tokens BETWEEN {f.min_total_tokens} AND {f.max_total_tokens}
  AND fewest_tokens >= {f.min_tokens_per_turn} AND most_tokens <= {f.max_tokens_per_turn}
  AND NOT refused
  AND (user_tokens = 0 OR assistant_tokens = 0 OR
       abs(user_tokens - assistant_tokens)::DOUBLE / (user_tokens + assistant_tokens)
         <= {f.balanced_conversation_ratio}::DOUBLE))"""


def judged_sql(config: CurationConfig, sum_mode: bool = False, special: int = 0) -> str:
    f = config.quality_filters
    return f"WITH {facts_sql(f, sum_mode, special)} SELECT *, {passes_sql(f)} AS passes FROM facts"


def exchange_passes(f: QualityFilters, sum_mode: bool = False, special: int = 0) -> str:
    """The checks on a user/assistant pair, from its ``u`` and ``a`` counts and its ``total``."""
    u, a = f"(u + {special})", f"(a + {special})"
    total = f"({u} + {a})" if sum_mode else "total"
    refusal = f"AND NOT {refused_sql(f, chr(39) + 'assistant' + chr(39), 'output')}"
    return f"""(1 BETWEEN {f.min_turns} AND {f.max_turns}
  AND {total} BETWEEN {f.min_total_tokens} AND {f.max_total_tokens}
  AND least({u}, {a}) >= {f.min_tokens_per_turn} AND greatest({u}, {a}) <= {f.max_tokens_per_turn}
  {refusal if f.check_for_refusal else ''}
  AND ({u} = 0 OR {a} = 0 OR
       abs({u} - {a})::DOUBLE / ({u} + {a}) <= {f.balanced_conversation_ratio}::DOUBLE))"""


def buckets_sql(source: str, key: str, column: str, dims: int) -> str:
    """``buckets``: key, bucket, c."""
    return f"""
buckets AS (
  SELECT {key} AS id, ('0x' || substr(md5(w), 1, 4))::BIGINT % {dims} AS bucket, count(*) AS c
  FROM (SELECT {key}, unnest({words(f'lower({column})')}) AS w FROM {source}) GROUP BY 1, 2)"""


def weighted_sql(source: str, key: str, column: str, dims: int) -> str:
    """``buckets`` with counts weighted by the rarity of the bucket."""
    raw = buckets_sql(source, key, column, dims).replace("buckets AS", "counts AS")
    return f"""{raw},
rarity AS (
  SELECT bucket, 1 + ln((SELECT count(*) FROM {source}) + 1.0::DOUBLE) - ln(count(*) + 1.0::DOUBLE) AS w
  FROM counts GROUP BY bucket),
buckets AS (SELECT id, bucket, c * w AS c FROM counts JOIN rarity USING (bucket))"""


def removed_sql(threshold: float) -> str:
    """``removed`` from ``alike`` (i, j, s: both directions)."""
    return f"""
nearest AS (
  SELECT i, j, s FROM alike WHERE s >= round({threshold}::DOUBLE, 9)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY s DESC, j) = 1),
removed AS (SELECT DISTINCT greatest(i, j) AS id FROM nearest)"""


SIMILAR_BUCKETS = """
lengths AS (SELECT id, sqrt(sum(c * c)::DOUBLE) AS len FROM buckets GROUP BY id),
alike AS (
  SELECT d.i, d.j, round(d.dot / (x.len * y.len), 9) AS s
  FROM (SELECT a.id AS i, b.id AS j, sum(a.c * b.c)::DOUBLE AS dot
        FROM buckets a JOIN buckets b ON a.bucket = b.bucket AND a.id <> b.id GROUP BY 1, 2) d
  JOIN lengths x ON x.id = d.i JOIN lengths y ON y.id = d.j)"""

def sparse_sql(threshold: float) -> str:
    """``nearest`` and ``removed`` of the documents' words by 28 bits of their md5, without folding."""
    wide = weighted_sql("documents", "doc_id", "text", 1 << 28).replace("1, 4))", "1, 7))")
    return f"WITH {wide}, {SIMILAR_BUCKETS}, {removed_sql(threshold)}"


def clusters_sql() -> str:
    """``roots``: id, cluster of every document with a match, by walking the matches."""
    return f"""WITH RECURSIVE {buckets_sql('documents', 'doc_id', 'text', 512)}, {SIMILAR_BUCKETS},
{removed_sql(DOCUMENT_THRESHOLD)},
ends AS (SELECT a.i FROM nearest a JOIN nearest b ON b.i = a.j AND b.j = a.i WHERE a.i < a.j),
walk AS (
  SELECT i AS id, i AS place FROM nearest
  UNION ALL
  SELECT w.id, n.j FROM walk w JOIN nearest n ON n.i = w.place WHERE w.place NOT IN (SELECT i FROM ends)),
roots AS (SELECT id, place AS cluster FROM walk WHERE place IN (SELECT i FROM ends))"""


SIMILAR_VECTORS = """
alike AS (
  SELECT a.vec_id AS i, b.vec_id AS j,
         round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS s
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""


def uniform(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"


def learning(key: str) -> str:
    return f"(0.3::DOUBLE + (1.0::DOUBLE - 0.3::DOUBLE) * {uniform(key)})"


def final_score(config: CurationConfig, value: str, quality: str = "1.0::DOUBLE") -> str:
    w = config.scoring_weights
    return (
        f"({w.learning_value}::DOUBLE * {value} + {w.quality}::DOUBLE * {quality}"
        f" + {w.diversity}::DOUBLE * 1.0::DOUBLE)"
    )


SCORED = f"""
scored AS (
  SELECT conv_id, {learning('conv_id')} AS learning_value,
         {final_score(INSTRUCT, learning('conv_id'))} AS final_score
  FROM (SELECT DISTINCT conv_id FROM conversations))"""


def pairs_sql(name: str, source: str, key: str, column: str) -> str:
    """``name``: key, prev, word for each token of a text; the first follows the start mark."""
    return f"""
{name} AS (
  SELECT {key}, CASE WHEN p = 1 THEN '' ELSE toks[p - 1] END AS prev, toks[p] AS word
  FROM (SELECT {key}, toks, unnest(range(1, len(toks) + 1)) AS p
        FROM (SELECT {key}, {words(column)} AS toks FROM {source})))"""


def model_sql(prefix: str, pairs: str) -> str:
    """``{prefix}_model``: prev, word, n, nll, and its parts."""
    return f"""
{prefix}_n AS (SELECT prev, word, count(*) AS n FROM {pairs} GROUP BY 1, 2),
{prefix}_w AS (SELECT word, sum(n)::BIGINT AS wn FROM {prefix}_n GROUP BY 1),
{prefix}_p AS (SELECT prev, sum(n)::BIGINT AS pn FROM {prefix}_n GROUP BY 1),
{prefix}_size AS (SELECT (sum(wn) + count(*))::DOUBLE AS size FROM {prefix}_w),
{prefix}_model AS (
  SELECT n.prev, n.word, n.n,
         -ln(0.5::DOUBLE * n.n / p.pn + 0.5::DOUBLE * (w.wn + 1) / (SELECT size FROM {prefix}_size)) AS nll
  FROM {prefix}_n n JOIN {prefix}_w w USING (word) JOIN {prefix}_p p USING (prev))"""


LAST_TURNS = """
last_turns AS (
  SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)"""


def run_sql(dedup: bool = True, by_perplexity: bool = False) -> str:
    """CTEs of a whole run up to ``scored``."""
    f = RUN.quality_filters
    parts = [
        facts_sql(f),
        f"passed AS (SELECT conv_id, n_messages FROM facts WHERE {passes_sql(f)})",
        f"""
contents AS (
  SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS t
  FROM conversations JOIN passed USING (conv_id) GROUP BY conv_id)""",
    ]
    if dedup:
        parts += [
            weighted_sql("contents", "conv_id", "t", RUN.deduplication.dims),
            SIMILAR_BUCKETS,
            removed_sql(RUN.deduplication.similarity_threshold),
            "kept AS (SELECT * FROM passed WHERE conv_id NOT IN (SELECT id FROM removed))",
        ]
    else:
        parts.append("kept AS (SELECT * FROM passed)")
    if by_perplexity:
        parts += [
            LAST_TURNS,
            "corpus AS (SELECT conv_id, turn, text FROM conversations JOIN kept USING (conv_id))",
            pairs_sql("corpus_pairs", "corpus", "conv_id", "text"),
            model_sql("lm", "corpus_pairs"),
            """answers AS (SELECT conv_id, text FROM last_turns JOIN kept USING (conv_id)
  WHERE role = 'assistant')""",
            pairs_sql("answer_pairs", "answers", "conv_id", "text"),
            """
losses AS (
  SELECT conv_id, avg(nll) AS loss FROM answer_pairs JOIN lm_model USING (prev, word) GROUP BY 1)""",
            """
raw AS (SELECT conv_id, n_messages,
               coalesce(CASE WHEN loss IS NOT NULL THEN least(exp(loss), 10000) END, 0) AS ppl
        FROM kept LEFT JOIN losses USING (conv_id))""",
        ]
        value = "CASE WHEN (SELECT max(ppl) FROM raw) > 0 THEN ppl / (SELECT max(ppl) FROM raw) ELSE 0 END"
        source = "raw"
    else:
        value, source = learning("conv_id"), "kept"
    parts.append(f"valued AS (SELECT conv_id, n_messages, {value} AS learning_value FROM {source})")
    parts.append(
        f"scored AS (SELECT *, {final_score(RUN, 'learning_value')} AS final_score FROM valued)"
    )
    return "WITH " + ",\n".join(parts)


def selection_sql(**options) -> str:
    return f"""{run_sql(**options)}
SELECT conv_id AS sample_id, n_messages, round(learning_value, 6) AS learning_value,
       round(final_score, 6) AS final_score,
       row_number() OVER (ORDER BY final_score DESC, conv_id) AS rank
FROM scored QUALIFY rank <= {TOP_K}"""


def render_sql(template: ChatTemplate) -> str:
    return f"""
SELECT conv_id, length(t) AS n_chars, md5(t) AS text_md5
FROM (SELECT conv_id, {text(template.bos)} ||
        string_agg({wrapped(template, 'role', 'text')}, '' ORDER BY turn) AS t
      FROM conversations GROUP BY 1)"""


def header_context() -> str:
    prompt = HEADER.before_role + "assistant" + HEADER.after_role
    return f"({text(HEADER.bos)} || {wrapped(HEADER, chr(39) + 'user' + chr(39), 'question')} || {text(prompt)})"


def ab_sql() -> str:
    f = WIDE.quality_filters
    return f"""
WITH {facts_sql(f)},
chosen AS (SELECT conv_id FROM facts WHERE {passes_sql(f)}),
sample AS (SELECT conv_id FROM facts ORDER BY md5('42:' || conv_id), conv_id
           LIMIT (SELECT count(*) FROM chosen)),
a_texts AS (SELECT conv_id, text FROM conversations WHERE conv_id IN (SELECT conv_id FROM sample)),
b_texts AS (SELECT conv_id, text FROM conversations WHERE conv_id IN (SELECT conv_id FROM chosen)),
{pairs_sql('a_pairs', 'a_texts', 'conv_id', 'text')},
{pairs_sql('b_pairs', 'b_texts', 'conv_id', 'text')},
{model_sql('a', 'a_pairs')},
{model_sql('b', 'b_pairs')},
sides AS (SELECT (SELECT sum(n * nll) / sum(n) FROM a_model) AS base,
                 (SELECT sum(n * nll) / sum(n) FROM b_model) AS opt)
SELECT round(base, 6) AS baseline_loss, round(opt, 6) AS optimized_loss,
       round(CASE WHEN base > 0 THEN (base - opt) / base * 100 ELSE 0 END, 6) AS loss_reduction_percentage
FROM sides"""


def oracles() -> dict[str, str]:
    chat_pair = (
        wrapped(CHATML, "'user'", "question") + " || " + wrapped(CHATML, "'assistant'", "output")
    )
    prompt = CHATML.before_role + "assistant" + CHATML.after_role
    chat_context = f"({wrapped(CHATML, chr(39) + 'user' + chr(39), 'question')} || {text(prompt)})"
    header_pair = (
        text(HEADER.bos)
        + " || "
        + wrapped(HEADER, "'user'", "question")
        + " || "
        + wrapped(HEADER, "'assistant'", "output")
    )
    f_wide, f_base = WIDE.quality_filters, BASE.quality_filters
    f_instruct = INSTRUCT.quality_filters
    out = {
        "assemble_messages": f"""
SELECT conv_id, count(*) AS n_messages,
       string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(text, chr(10) ORDER BY turn)) AS content_md5
FROM conversations GROUP BY 1""",
        "alpaca_to_messages": f"""
WITH {EXCHANGES}
SELECT conv_id || ':' || turn AS key, 'user,assistant' AS roles,
       md5(question) AS user_md5, md5(output) AS assistant_md5 FROM asked""",
        "parse_json_records": f"""
WITH {EXCHANGES}
SELECT conv_id, turn, md5(instruction) AS instruction_md5, length(input) AS input_length,
       md5(output) AS output_md5 FROM exchanges""",
        "jsonl_round_trip": f"""
WITH {EXCHANGES},
texts AS (SELECT question AS t FROM asked UNION ALL SELECT output FROM asked)
SELECT (SELECT count(*) FROM asked) AS n_rows, 0::BIGINT AS first_id,
       (SELECT count(*) - 1 FROM asked) AS last_id,
       (SELECT sum(length(t))::BIGINT FROM texts) AS n_chars,
       (SELECT count(DISTINCT t) FROM texts) AS n_texts""",
        "dataset_split": f"""
WITH {EXCHANGES}
SELECT conv_id, turn, 'train' AS split, md5(output) AS answer_md5 FROM asked WHERE conv_id % 3 <> 0""",
        "scoring_text": f"""
WITH {EXCHANGES},
built AS (SELECT conv_id, turn, {header_context()} AS c, output FROM asked)
SELECT conv_id, turn, length(c) AS context_chars, md5(c) AS context_md5,
       length(c || output || {text(HEADER.eos)}) AS whole_chars,
       md5(c || output || {text(HEADER.eos)}) AS whole_md5 FROM built""",
        "token_counts": f"SELECT conv_id, turn, {n_tokens('text')} AS n_tokens FROM conversations",
        "rendered_token_counts": f"""
SELECT conv_id, {n_tokens('c')} AS chatml_tokens, {n_tokens('h')} AS header_tokens
FROM (SELECT conv_id, string_agg({wrapped(CHATML, 'role', 'text')}, '' ORDER BY turn) AS c,
             {text(HEADER.bos)} || string_agg({wrapped(HEADER, 'role', 'text')}, '' ORDER BY turn) AS h
      FROM conversations GROUP BY conv_id)""",
        "total_tokens_with_specials": f"""
WITH {EXCHANGES}
SELECT conv_id, turn, {n_tokens(header_pair)} + 1 AS total_tokens,
       {n_tokens('question')} AS user_tokens, {n_tokens('output')} AS assistant_tokens FROM asked""",
        "turn_counts": """
SELECT conv_id, count(*) AS n_messages, count(*) // 2 AS turns FROM conversations GROUP BY 1""",
        "role_token_sums": f"""
WITH {facts_sql(INSTRUCT.quality_filters)} SELECT conv_id, user_tokens, assistant_tokens FROM facts""",
        "conversation_balance": f"""
WITH {facts_sql(INSTRUCT.quality_filters)}
SELECT conv_id, CASE WHEN user_tokens > 0 AND assistant_tokens > 0 THEN
  round(abs(user_tokens - assistant_tokens)::DOUBLE / (user_tokens + assistant_tokens), 6) END
  AS balance_ratio FROM facts""",
        "truncate_to_budget": f"""
WITH {EXCHANGES},
counted AS (SELECT conv_id, turn, {n_tokens(chat_context)} AS context_tokens,
                   {n_tokens('output')} AS response_tokens FROM asked)
SELECT *, least(response_tokens, greatest({TOKEN_BUDGET} - context_tokens, 0)) AS kept_tokens
FROM counted""",
        "user_tokenizer_counts": r"""
SELECT conv_id, turn, len(regexp_extract_all(text, '\S+')) AS n_tokens FROM conversations""",
        "user_batch_map": """
SELECT conv_id, turn, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines
FROM conversations""",
        "quality_filter_instruct": judged_sql(INSTRUCT),
        "quality_filter_optimized": judged_sql(OPTIMIZED),
        "quality_filter_base": judged_sql(BASE),
        "quality_filter_wide": judged_sql(WIDE),
        "quality_filter_message_sums": judged_sql(WIDE, sum_mode=True, special=1),
        "quality_filter_nested": f"""
WITH {EXCHANGES},
counted AS (SELECT conv_id, turn, output, {n_tokens('question')} AS u, {n_tokens('output')} AS a,
                   {n_tokens(chat_pair)} AS total FROM asked)
SELECT conv_id, turn, {exchange_passes(f_wide)} AS passes,
       {exchange_passes(f_base)} AS passes_base,
       {exchange_passes(f_wide, True, 1)} AS passes_sum FROM counted""",
        "refusal_filter": f"""
SELECT conv_id, turn,
       regexp_matches(text, {phrases(INSTRUCT.quality_filters.refusal_patterns + EXTRA_PHRASES)}) AS refused
FROM conversations WHERE role = 'assistant'""",
        "filter_stage_counts": f"""
WITH {facts_sql(f_wide)}
SELECT count(*) AS original, count(*) FILTER ({passes_sql(f_wide)}) AS passed,
       count(*) FILTER (starts_with_user) AS starting_with_user,
       count(*) FILTER (roles_allowed) AS with_allowed_roles FROM facts""",
        "hashed_features": f"""
WITH {buckets_sql('documents', 'doc_id', 'text', 512)}
SELECT doc_id, coalesce(sum(c), 0)::BIGINT AS n_words, count(c) AS n_buckets,
       round(sqrt(coalesce(sum(c * c), 0)::DOUBLE), 6) AS length
FROM documents LEFT JOIN buckets ON id = doc_id GROUP BY doc_id""",
        "unit_vectors": """
WITH sized AS (SELECT vec_id, embedding::DOUBLE[] AS e,
                      sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS len
               FROM embeddings)
SELECT vec_id, round(e[1] / len, 6) AS first_entry, 1.0::DOUBLE AS length FROM sized""",
        "cosine_to_next": """
SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "mean_pooled_vectors": """
SELECT label::BIGINT AS label, p - 1 AS position, round(avg(embedding[p]::DOUBLE), 6) AS mean_entry
FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)
GROUP BY 1, 2""",
        "dedup_vectors": f"""
WITH {SIMILAR_VECTORS}, {removed_sql(VECTOR_THRESHOLD)}
SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM removed)""",
        "nearest_vectors": f"""
WITH {SIMILAR_VECTORS}, {removed_sql(VECTOR_THRESHOLD)}
SELECT i AS id, j AS match_id, round(s, 6) AS similarity FROM nearest""",
        "nearest_documents": f"""
WITH {buckets_sql('documents', 'doc_id', 'text', 512)}, {SIMILAR_BUCKETS}, {removed_sql(DOCUMENT_THRESHOLD)}
SELECT i AS id, j AS match_id, round(s, 6) AS similarity FROM nearest""",
        "dedup_documents": f"""
WITH {buckets_sql('documents', 'doc_id', 'text', 512)}, {SIMILAR_BUCKETS}, {removed_sql(DOCUMENT_THRESHOLD)}
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM removed)""",
        "removed_documents": f"""
WITH {buckets_sql('documents', 'doc_id', 'text', 512)}, {SIMILAR_BUCKETS}, {removed_sql(DOCUMENT_THRESHOLD)}
SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT id FROM removed)""",
        "hash_random_scores": f"""
WITH {SCORED} SELECT conv_id, round(learning_value, 6) AS learning_value FROM scored""",
        "combined_scores": f"""
WITH {SCORED} SELECT conv_id, round(learning_value, 6) AS learning_value,
  round(final_score, 6) AS final_score FROM scored""",
        "quality_column_join": f"""
SELECT d.doc_id, round({final_score(INSTRUCT, learning('d.doc_id'),
                                     'coalesce(l.quality::DOUBLE, 1.0::DOUBLE)')}, 6) AS final_score
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "top_k_selection": f"""
WITH {SCORED}
SELECT conv_id, round(final_score, 6) AS final_score,
       row_number() OVER (ORDER BY final_score DESC, conv_id) AS rank
FROM scored QUALIFY rank <= {TOP_K}""",
        "top_half_selection": f"""
WITH s AS (SELECT doc_id, {final_score(INSTRUCT, learning('doc_id'))} AS x FROM documents)
SELECT doc_id, round(x, 6) AS final_score, row_number() OVER (ORDER BY x DESC, doc_id) AS rank
FROM s QUALIFY rank <= greatest((SELECT count(*) FROM documents) // 2, 1)""",
        "score_statistics": f"""
WITH {SCORED}
SELECT round(avg(final_score), 6) AS mean, round(stddev_pop(final_score), 6) AS std,
       round(min(final_score), 6) AS min, round(max(final_score), 6) AS max FROM scored""",
        "random_baseline": f"""
SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
ORDER BY md5('42:' || conv_id), conv_id LIMIT {TOP_K}""",
        "response_split": f"""
WITH {LAST_TURNS}
SELECT conv_id, turn AS context_messages, role AS last_role, role = 'assistant' AS scorable,
       CASE WHEN role = 'assistant' THEN {n_tokens('text')} ELSE 0 END AS response_tokens
FROM last_turns""",
        "response_perplexity": f"""
WITH {LAST_TURNS},
{pairs_sql('corpus_pairs', 'conversations', 'conv_id', 'text')},
{model_sql('lm', 'corpus_pairs')},
answers AS (SELECT conv_id, text FROM last_turns WHERE role = 'assistant'),
{pairs_sql('answer_pairs', 'answers', 'conv_id', 'text')},
losses AS (SELECT conv_id, avg(nll) AS loss FROM answer_pairs JOIN lm_model USING (prev, word) GROUP BY 1),
raw AS (SELECT conv_id,
               coalesce(CASE WHEN loss IS NOT NULL THEN least(exp(loss), 10000) END, 0) AS ppl
        FROM last_turns LEFT JOIN losses USING (conv_id))
SELECT conv_id, round(ppl, 4) AS perplexity, round(ppl / (SELECT max(ppl) FROM raw), 6) AS learning_value
FROM raw""",
        "perplexity_under_other_corpus": f"""
WITH {pairs_sql('corpus_pairs', 'conversations', 'conv_id', 'text')},
{model_sql('lm', 'corpus_pairs')},
{pairs_sql('doc_pairs', 'documents', 'doc_id', 'text')},
losses AS (
  SELECT doc_id, avg(coalesce(m.nll, ln((SELECT size FROM lm_size)) - ln(0.5::DOUBLE)
                                     - ln(coalesce(w.wn, 0) + 1))) AS loss
  FROM doc_pairs d LEFT JOIN lm_model m ON m.prev = d.prev AND m.word = d.word
  LEFT JOIN lm_w w ON w.word = d.word GROUP BY 1)
SELECT doc_id, round(coalesce(CASE WHEN loss IS NOT NULL THEN least(exp(loss), 10000) END, 0), 3) AS perplexity
FROM documents LEFT JOIN losses USING (doc_id)""",
        "user_model_scores": f"""
WITH {EXCHANGES}
SELECT conv_id, turn, round(length(output) / (1.0::DOUBLE + length({chat_context})), 6) AS mean_nll
FROM asked""",
        "compare_with_baseline": ab_sql(),
        "exact_dedup": r"""
SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents
GROUP BY trim(regexp_replace(lower(coalesce(text, '')), '[ \t\n\r\f\x0B]+', ' ', 'g'))""",
        "rejection_funnel": f"""
WITH {facts_sql(f_instruct)}
SELECT CASE WHEN n_messages // 2 NOT BETWEEN {f_instruct.min_turns} AND {f_instruct.max_turns} THEN 'turns'
            WHEN NOT starts_with_user THEN 'first_role' WHEN NOT roles_allowed THEN 'roles'
            WHEN total_tokens NOT BETWEEN {f_instruct.min_total_tokens} AND {f_instruct.max_total_tokens}
              THEN 'total_tokens'
            WHEN fewest_tokens < {f_instruct.min_tokens_per_turn}
              OR most_tokens > {f_instruct.max_tokens_per_turn} THEN 'message_tokens'
            WHEN refused THEN 'refusal'
            WHEN user_tokens > 0 AND assistant_tokens > 0
              AND abs(user_tokens - assistant_tokens)::DOUBLE / (user_tokens + assistant_tokens)
                > {f_instruct.balanced_conversation_ratio}::DOUBLE THEN 'balance' END AS reason,
       count(*) AS n FROM facts GROUP BY 1""",
        "reduction_ratio": f"""
WITH {facts_sql(f_wide)},
c AS (SELECT count(*) AS before, count(*) FILTER ({passes_sql(f_wide)}) AS after FROM facts)
SELECT before, after, printf('%.2f%%', 100.0 * (before - after) / before) AS reduction_percentage FROM c""",
        "curate_conversations": selection_sql(),
        "curate_by_perplexity": selection_sql(by_perplexity=True),
        "curate_without_dedup": selection_sql(dedup=False),
        "curation_report": f"""{run_sql()},
sizes AS (SELECT (SELECT count(*) FROM facts) AS o, (SELECT count(*) FROM passed) AS p,
                 count(*) AS k, least(count(*), {TOP_K}) AS n,
                 avg(final_score) AS a, stddev_pop(final_score) AS s,
                 min(final_score) AS lo, max(final_score) AS hi FROM scored)
SELECT '{RUN.name}' AS config_used, o AS original_size, p AS size_after_quality_filter,
       k AS size_after_deduplication, n AS optimized_size,
       printf('%.2f%%', 100.0 * (o - n) / o) AS reduction_percentage, NULL::VARCHAR AS note,
       round(a, 6) AS score_mean, round(s, 6) AS score_std, round(lo, 6) AS score_min,
       round(hi, 6) AS score_max FROM sizes""",
        "curate_exchanges": f"""
WITH {EXCHANGES},
counted AS (SELECT conv_id || ':' || turn AS sample_id, output, question, {n_tokens('question')} AS u,
                   {n_tokens('output')} AS a, {n_tokens(chat_pair)} AS total FROM asked),
passed AS (SELECT sample_id, question || chr(10) || output AS t FROM counted WHERE {exchange_passes(RUN.quality_filters)}),
{weighted_sql('passed', 'sample_id', 't', RUN.deduplication.dims)},
{SIMILAR_BUCKETS},
{removed_sql(RUN.deduplication.similarity_threshold)},
valued AS (SELECT sample_id, {learning('sample_id')} AS learning_value FROM passed
           WHERE sample_id NOT IN (SELECT id FROM removed)),
scored AS (SELECT *, {final_score(RUN, 'learning_value')} AS final_score FROM valued)
SELECT sample_id, round(learning_value, 6) AS learning_value, round(final_score, 6) AS final_score,
       row_number() OVER (ORDER BY final_score DESC, sample_id) AS rank
FROM scored QUALIFY rank <= {TOP_K}""",
        "curate_by_column": f"""
WITH {EXCHANGES},
counted AS (SELECT conv_id || ':' || turn AS sample_id, turn, output, {n_tokens('question')} AS u,
                   {n_tokens('output')} AS a, {n_tokens(chat_pair)} AS total FROM asked),
scored AS (SELECT sample_id, (turn % 7) / 7.0::DOUBLE AS learning_value,
                  {final_score(RUN, '((turn % 7) / 7.0::DOUBLE)')} AS final_score
           FROM counted WHERE {exchange_passes(RUN.quality_filters)})
SELECT sample_id, round(learning_value, 6) AS learning_value, round(final_score, 6) AS final_score,
       row_number() OVER (ORDER BY final_score DESC, sample_id) AS rank
FROM scored QUALIFY rank <= {TOP_K}""",
        "curate_by_model": f"""
WITH {EXCHANGES},
counted AS (SELECT conv_id || ':' || turn AS sample_id, question, output, {n_tokens('question')} AS u,
                   {n_tokens('output')} AS a, {n_tokens(chat_pair)} AS total FROM asked),
raw AS (SELECT sample_id, least(exp(length(output) / (1.0::DOUBLE + length({chat_context}))), 10000) AS ppl
        FROM counted WHERE {exchange_passes(RUN.quality_filters)}),
valued AS (SELECT sample_id, ppl / (SELECT max(ppl) FROM raw) AS learning_value FROM raw),
scored AS (SELECT *, {final_score(RUN, 'learning_value')} AS final_score FROM valued)
SELECT sample_id, round(learning_value, 6) AS learning_value, round(final_score, 6) AS final_score,
       row_number() OVER (ORDER BY final_score DESC, sample_id) AS rank
FROM scored QUALIFY rank <= {TOP_K}""",
        "empty_run_report": f"""
WITH {EXCHANGES}
SELECT '{OPTIMIZED.name}' AS config_used, count(*) AS original_size,
       0::BIGINT AS size_after_quality_filter, 0::BIGINT AS size_after_deduplication,
       0::BIGINT AS optimized_size, '100.00%' AS reduction_percentage,
       'No row passed the filters; looser thresholds would keep some.' AS note,
       NULL::DOUBLE AS score_mean, NULL::DOUBLE AS score_std,
       NULL::DOUBLE AS score_min, NULL::DOUBLE AS score_max FROM asked""",
    }
    for template in (CHATML, HEADER, ROLE_TAG):
        out[f"render_{template.name}"] = render_sql(template)
    letters = "etaoinshrdlu"
    counts = ", ".join(
        f"(length(lower(text)) - length(replace(lower(text), '{c}', '')))::DOUBLE" for c in letters
    )
    out["dedup_documents_sparse"] = f"""{sparse_sql(DOCUMENT_THRESHOLD)}
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM removed)"""
    out["nearest_documents_sparse"] = f"""{sparse_sql(SPARSE_THRESHOLD)}
SELECT i AS id, j AS match_id, round(s, 6) AS similarity FROM nearest"""
    out["similar_clusters"] = f"{clusters_sql()} SELECT id, cluster FROM roots"
    out["max_similar"] = f"""{clusters_sql()}
SELECT doc_id, coalesce(cluster, doc_id) AS cluster FROM documents LEFT JOIN roots ON id = doc_id
QUALIFY row_number() OVER (PARTITION BY coalesce(cluster, doc_id)
                           ORDER BY {learning('doc_id')} DESC, doc_id) <= {MOST_SIMILAR}"""
    out["perplexity_band"] = f"""
SELECT conv_id, learning_value FROM ({out['response_perplexity']})
WHERE learning_value BETWEEN {PERPLEXITY_BAND[0]} AND {PERPLEXITY_BAND[1]}"""
    out["jsonl_lenient"] = """
WITH lines AS (
  SELECT *, conv_id * 1000 + turn AS id, conv_id % 5 = 0 AS cut, turn % 2 = 0 AS listed, conv_id % 7 = 0 AS other
  FROM conversations),
written AS (
  SELECT *, CASE WHEN listed THEN to_json(struct_pack(id := id, messages := [struct_pack(role := role, content := text)]))
                 WHEN other THEN to_json(struct_pack(id := id, text := text))
                 ELSE to_json(struct_pack(id := id, instruction := role, response := text)) END::VARCHAR AS line,
         NOT cut AND (listed OR NOT other) AS good
  FROM lines)
SELECT CASE WHEN NOT cut THEN id END AS id,
       CASE WHEN NOT good THEN 0 WHEN listed THEN 1 ELSE 2 END::BIGINT AS n_messages,
       CASE WHEN good THEN md5(CASE WHEN listed THEN text ELSE role || '|' || text END) END AS content_md5,
       CASE WHEN NOT good THEN md5(CASE WHEN cut THEN left(line, length(line) - 3) ELSE line END) END AS corrupt_md5
FROM written"""
    out["response_perplexity_loo"] = f"""
WITH {LAST_TURNS},
{pairs_sql('corpus_pairs', 'conversations', 'conv_id', 'text')},
{model_sql('lm', 'corpus_pairs')},
answers AS (SELECT conv_id, text FROM last_turns WHERE role = 'assistant'),
{pairs_sql('answer_pairs', 'answers', 'conv_id', 'text')},
own AS (SELECT conv_id, prev, word, count(*) AS c FROM answer_pairs GROUP BY ALL),
parts AS (
  SELECT conv_id, word, c, n, pn, wn, sum(c) OVER (PARTITION BY conv_id)::DOUBLE AS t,
         sum(c) OVER (PARTITION BY conv_id, prev)::BIGINT AS cp,
         sum(c) OVER (PARTITION BY conv_id, word)::BIGINT AS cw
  FROM own JOIN lm_n USING (prev, word) JOIN lm_p USING (prev) JOIN lm_w USING (word)),
gone AS (SELECT conv_id, count(DISTINCT word) FILTER (wn = cw) AS v FROM parts GROUP BY 1),
losses AS (
  SELECT conv_id, sum(c * -ln(0.5::DOUBLE * CASE WHEN pn > cp THEN (n - c)::DOUBLE / (pn - cp) ELSE 0 END
                              + 0.5::DOUBLE * (wn - cw + 1) / greatest((SELECT size FROM lm_size) - t - v, 1)))
                  / sum(c)::DOUBLE AS loss
  FROM parts JOIN gone USING (conv_id) GROUP BY 1),
raw AS (SELECT conv_id, coalesce(CASE WHEN loss IS NOT NULL THEN least(exp(loss), 10000) END, 0) AS ppl
        FROM last_turns LEFT JOIN losses USING (conv_id))
SELECT conv_id, round(ppl, 6) AS perplexity, round(ppl / (SELECT max(ppl) FROM raw), 6) AS learning_value FROM raw"""
    hashed = "0::BIGINT"
    for k in range(CHARACTERS):
        hashed = f"({hashed} * {GRAM_BASE} + points[p + {k}]) % {GRAM_MODULUS}"
    out["hashed_char_features"] = f"""
WITH low AS (
  SELECT doc_id, list_transform(regexp_extract_all(lower(coalesce(text, '')), '(?s).'), lambda c: unicode(c)) AS points
  FROM documents),
grams AS (SELECT doc_id, points, unnest(range(1, len(points) - {CHARACTERS - 2})) AS p FROM low),
buckets AS (SELECT doc_id, {hashed} % 512 AS bucket, count(*) AS c FROM grams GROUP BY 1, 2)
SELECT doc_id, coalesce(sum(c), 0)::BIGINT AS n_grams, count(c) AS n_buckets,
       round(sqrt(coalesce(sum(c * c), 0)::DOUBLE), 6) AS length
FROM documents LEFT JOIN buckets USING (doc_id) GROUP BY doc_id"""
    bands, bits = PLANES["bands"], PLANES["bits"]
    out["nearest_by_hyperplanes"] = f"""
WITH normals AS (
  SELECT band, bit, list(CASE WHEN ('0x' || substr(md5('42:' || band || ':' || bit || ':' || d), 1, 1))::INT < 8
                              THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY d) AS normal
  FROM range({bands}) AS a(band), range({bits}) AS b(bit), range(64) AS c(d) GROUP BY 1, 2),
marks AS (
  SELECT vec_id, band, sum(CASE WHEN list_inner_product(embedding::DOUBLE[], normal) >= 0 THEN 1 << bit ELSE 0 END) AS mark
  FROM embeddings, normals GROUP BY 1, 2),
met AS (
  SELECT DISTINCT a.vec_id AS i, b.vec_id AS j
  FROM marks a JOIN marks b ON a.band = b.band AND a.mark = b.mark AND a.vec_id <> b.vec_id),
alike AS (
  SELECT i, j, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS s
  FROM met JOIN embeddings a ON a.vec_id = i JOIN embeddings b ON b.vec_id = j),
{removed_sql(VECTOR_THRESHOLD)}
SELECT i AS id, j AS match_id, round(s, 6) AS similarity FROM nearest"""
    out["stream_filter"] = f"""
WITH {facts_sql(WIDE.quality_filters)}
SELECT conv_id, n_messages FROM facts WHERE {passes_sql(WIDE.quality_filters)}"""
    judged = judged_sql(REFUSING)
    out["refused_conversations"] = f"SELECT conv_id, n_messages, refused, passes FROM ({judged})"
    out["quality_filter_whole"] = f"SELECT conv_id, n_messages, coalesce(passes, false) AS passes FROM ({judged})"
    out["user_encoder_dedup"] = f"""
WITH v AS (SELECT doc_id, [{counts}] AS e FROM documents),
alike AS (SELECT a.doc_id AS i, b.doc_id AS j, round(list_cosine_similarity(a.e, b.e), 9) AS s
            FROM v a JOIN v b ON a.doc_id <> b.doc_id
            WHERE list_sum(a.e) > 0 AND list_sum(b.e) > 0),
{removed_sql(0.9999)}
SELECT doc_id FROM v WHERE doc_id NOT IN (SELECT id FROM removed)"""
    out["hashed_features_idf"] = f"""
WITH d AS (SELECT doc_id, text FROM documents),
{buckets_sql('d', 'doc_id', 'text', 64)},
w AS (SELECT bucket, ln((SELECT count(*) FROM d) + 1.0::DOUBLE) - ln(count(*) + 1.0::DOUBLE) AS idf
      FROM buckets GROUP BY bucket)
SELECT doc_id, round(sqrt(coalesce(sum((c * idf) * (c * idf)), 0)), 6) AS length
FROM d LEFT JOIN buckets ON id = doc_id LEFT JOIN w USING (bucket) GROUP BY doc_id"""
    return out
