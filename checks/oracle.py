"""DuckDB SQL giving the same rows as each registered query.

The SQL takes its own route: set operations on lists and windows instead of the library's
column expressions. Merges are found by a recursive table whose rows are the words.
"""

from __future__ import annotations

from checks.inputs import MAX_LENGTH, MERGES
from corpusmill.functions.byte_symbols import SYMBOLS
from corpusmill.functions.chat import SYSTEM_PROMPT
from corpusmill.operators.tokenizer import SPECIAL_TOKENS

_SQL: dict[str, str] = {}

L = MAX_LENGTH
NL = "chr(10)"
_ORDERED = sorted(SYMBOLS)
_IDS = [5 + _ORDERED.index(s) for s in SYMBOLS]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _frame(role: str, content: str) -> str:
    return f"('<|im_start|>' || {role} || {NL} || {content} || '<|im_end|>' || {NL})"


def _per_byte(expr: str, values: list[str]) -> str:
    """List with one value per UTF-8 byte."""
    return (
        f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), "
        f"lambda h: ([{', '.join(values)}])[CAST('0x' || h AS INT) + 1])"
    )


BYTE_ID_LIST = [str(i) for i in _IDS]
BYTE_SYMBOL_LIST = [_text(s) for s in SYMBOLS]
BYTE_CHAR_LIST = [f"chr({256 + i})" for i in _IDS]


def _byte_ids(expr: str) -> str:
    return _per_byte(expr, BYTE_ID_LIST)


def _joined(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


def _padded(ids: str, pad: int) -> str:
    return (
        f"list_concat({ids}[1:{L}], "
        f"list_transform(range(greatest({L} - len({ids}), 0)), lambda i: {pad}))"
    )


def _bits(n: str) -> str:
    return (
        f"list_concat(list_transform(range(least({n}, {L})), lambda i: 1), "
        f"list_transform(range(greatest({L} - {n}, 0)), lambda i: 0))"
    )


# Byte-level pre-token pattern without the look-ahead DuckDB lacks; the tables hold no run
# of two whitespace characters, so it makes no difference.
WORDS = _text(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
)

# Derived inputs -------------------------------------------------------------

RAW = f"""
raw AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS line_no, doc_id, lang,
    CASE doc_id % 20
      WHEN 0 THEN ''
      WHEN 1 THEN left(rec, length(rec) - 1)
      WHEN 2 THEN rec || ' x'
      WHEN 3 THEN json_object('title', text)::VARCHAR
      WHEN 4 THEN '{{"text": 5}}'
      WHEN 5 THEN '{{"text": null}}'
      WHEN 6 THEN '{{"text": ""}}'
      WHEN 7 THEN '{{"text": "   "}}'
      ELSE rec END AS value
  FROM (SELECT *, json_object('text', text)::VARCHAR AS rec FROM documents))
"""

# Text of a raw line when it is a non-empty JSON string under "text".
RAW_TEXT = RAW + f""",
texts AS (
  SELECT line_no, lang, value,
    CASE WHEN json_valid(value) AND json_type(value, '$.text') = 'VARCHAR'
         THEN nullif(json_extract_string(value, '$.text'), '') END AS text
  FROM raw)
"""

LINES = f"""
doc_lines AS (
  SELECT doc_id, unnest(parts) AS value, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(text, {NL}) AS parts FROM documents)),
lines AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) AS line_no, value FROM doc_lines)
"""

FROM = """CASE WHEN role = 'user' THEN 'human'
  WHEN role = 'assistant' AND conv_id % 2 = 0 THEN 'gpt' ELSE role END"""

RENDERED = f"""
rendered AS (
  SELECT conv_id, string_agg({_frame('role', 'text')}, '' ORDER BY turn)
    FILTER (role IN ('system', 'user', 'assistant')) AS r
  FROM conversations GROUP BY conv_id)
"""

CHAT_BYTES = f"""
chat_ids AS (
  SELECT conv_id, flatten(list(
    list_concat([3], {_byte_ids(f"role || {NL} || text")}, [4], {_byte_ids(NL)})
    ORDER BY turn)) AS ids
  FROM conversations WHERE role IN ('system', 'user', 'assistant') GROUP BY conv_id)
"""

DOC_BYTES = f"doc_ids AS (SELECT doc_id, {_byte_ids('text')} AS ids FROM documents)"

DOC_WORDS = f"""
doc_words AS (
  SELECT doc_id, lang, source, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, lang, source, regexp_extract_all(text, {WORDS}) AS ws FROM documents)),
counts AS (SELECT w AS word, count(*) AS freq FROM doc_words GROUP BY w)
"""


def _training() -> str:
    """Common tables ``hist`` (three characters a merge: left, right, merged) and ``names``.

    Each step of ``train`` merges the best pair in all words that have one; the row of frequency 0
    gathers the merges.
    """
    return f"""{DOC_WORDS},
train(w, freq, seg, k) USING KEY (w) AS (
  SELECT word, freq, array_to_string({_per_byte('word', BYTE_CHAR_LIST)}, ''), 0 FROM counts
  UNION ALL SELECT '', 0, '', 0
  UNION
  SELECT w, freq, CASE WHEN freq = 0 THEN seg || pair || chr(517 + k) ELSE replace(seg, pair, chr(517 + k)) END, k + 1
  FROM train, (
    SELECT pair FROM (
      SELECT unnest(list_transform(range(1, length(seg)), lambda i: substr(seg, i, 2))) AS pair, freq
      FROM train WHERE freq > 0 AND length(seg) > 1)
    GROUP BY pair HAVING sum(freq) >= 2 ORDER BY sum(freq) DESC, pair LIMIT 1)
  WHERE k < {MERGES} AND (freq = 0 OR length(seg) > 1)),
hist AS MATERIALIZED (SELECT regexp_extract_all(seg, '(?s)...') AS merges FROM train WHERE freq = 0),
names(k, t) AS (
  SELECT 0, [{', '.join(_text(t) for t in [*SPECIAL_TOKENS, *_ORDERED])}]
  UNION ALL
  SELECT k + 1, list_append(t, t[unicode(substr(merges[k + 1], 1, 1)) - 255] || t[unicode(substr(merges[k + 1], 2, 1)) - 255])
  FROM names, hist WHERE k < len(merges)),
named AS MATERIALIZED (SELECT t FROM names ORDER BY k DESC LIMIT 1)"""


def _merged(expr: str) -> str:
    return (
        f"list_reduce((SELECT merges FROM hist), "
        f"lambda a, m: replace(a, substr(m, 1, 2), substr(m, 3, 1)), {expr})"
    )


def _coded(words: str, key: str, out: str) -> str:
    """Ids per key from ``(key, place, w, special)`` occurrences in the table ``words``."""
    seg = _merged(f"array_to_string({_per_byte('w', BYTE_CHAR_LIST)}, '')")
    return f"""
{out}_seg AS MATERIALIZED (
  SELECT w, {seg} AS seg FROM (SELECT DISTINCT w FROM {words} WHERE special IS NULL)),
{out}_ids AS MATERIALIZED (
  SELECT {key}, list_transform(
      string_split(string_agg(coalesce(chr(256 + special), seg), '' ORDER BY place), ''),
      lambda c: unicode(c) - 256) AS ids
  FROM {words} LEFT JOIN {out}_seg USING (w) GROUP BY {key})
"""


def _doc_coded() -> str:
    return ",\n".join(
        [
            _training(),
            "doc_occ AS (SELECT doc_id, pos AS place, w, CAST(NULL AS INT) AS special FROM doc_words)",
            _coded("doc_occ", "doc_id", "doc"),
        ]
    )


def _chat_coded(before: str = "", after: str = "") -> str:
    """Ids of the framed chats, with optional special tokens around them."""
    return ",\n".join(
        [
            _training(),
            f"""chat_parts AS (
  SELECT conv_id, turn * 4 AS k, '<|im_start|>' AS part, 3 AS special FROM chats
  UNION ALL SELECT conv_id, turn * 4 + 1, role || {NL} || text, NULL FROM chats
  UNION ALL SELECT conv_id, turn * 4 + 2, '<|im_end|>', 4 FROM chats
  UNION ALL SELECT conv_id, turn * 4 + 3, {NL}, NULL FROM chats {before} {after})""",
            f"""chat_occ AS (
  SELECT conv_id, [k, pos] AS place, w, special FROM (
    SELECT conv_id, k, special, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
      SELECT conv_id, k, special, CASE WHEN special IS NULL
        THEN regexp_extract_all(part, {WORDS}) ELSE [part] END AS ws FROM chat_parts)))""",
            _coded("chat_occ", "conv_id", "chat"),
        ]
    ).replace(
        "chat_parts AS (",
        "chats AS (SELECT * FROM conversations WHERE role IN ('system', 'user', 'assistant')),\n"
        "chat_parts AS (",
        1,
    )


def _assistant_bits(source: str, header: str, width: int) -> str:
    """``bits(conv_id, mask)`` from ``source(conv_id, ids)`` by windows over positions."""
    same = " AND ".join(
        f"lag(id, {width - i}) OVER w = ({header})[{i + 1}]" for i in range(width)
    )
    return f"""
pos AS (
  SELECT conv_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM {source}),
opened AS (
  SELECT conv_id, id, p, CASE WHEN {same} THEN p END AS s FROM pos
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
bits AS (
  SELECT conv_id, list(CAST(coalesce(st > coalesce(en, -1) AND p <= last, false) AS INT) ORDER BY p) AS mask
  FROM (
    SELECT conv_id, p,
      max(s) OVER (PARTITION BY conv_id ORDER BY p) AS st,
      max(CASE WHEN id = 4 THEN p END) OVER (
        PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS en,
      max(CASE WHEN id = 4 THEN p END) OVER (PARTITION BY conv_id) AS last
    FROM opened)
  GROUP BY conv_id)
"""


# Sources and sinks ----------------------------------------------------------

_SQL["read_lines"] = f"WITH {LINES} SELECT line_no, value FROM lines"

_SQL["parse_json_strict"] = f"""
WITH {RAW} SELECT line_no, CAST(json_valid(value) AS INT) AS is_json,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.title') END AS title FROM raw"""

_SQL["detect_layout"] = """
WITH turns AS (
  SELECT list({'from': role, 'value': text} ORDER BY turn) AS conversations FROM conversations GROUP BY conv_id),
files AS (
  SELECT 'array' AS kind, string_agg(to_json(conversations)::VARCHAR, chr(10)) AS body FROM turns
  UNION ALL SELECT 'jsonl', string_agg(json_object('conversations', conversations)::VARCHAR, chr(10)) FROM turns)
SELECT kind, CASE WHEN left(ltrim(body), 1) = '[' THEN 'array' ELSE 'jsonl' END AS layout FROM files"""

_SQL["read_json_array"] = """
SELECT conv_id, CAST(count(*) AS INT) AS turns, string_agg(text, '|' ORDER BY turn) AS texts
FROM conversations GROUP BY conv_id
UNION ALL
SELECT -1 - conv_id, CAST(count(*) FILTER (role = 'system') AS INT),
  coalesce(string_agg(text, '|' ORDER BY turn) FILTER (role = 'system'), '')
FROM conversations GROUP BY conv_id"""

_SQL["write_jsonl"] = (
    f"WITH {RENDERED} SELECT r AS rendered, count(*) AS chats FROM rendered GROUP BY r"
)

_EPOCH = "md5('42:' || {epoch} || ':' || {id})"


def _ranked(table: str, key: str, epoch: int = 0, columns: str = "") -> str:
    order = _EPOCH.format(epoch=epoch, id=key)
    return (
        f"SELECT {key}{columns}, row_number() OVER (ORDER BY {order}, {key}) - 1 AS rank FROM {table}"
    )


_SQL["write_samples"] = f"""
WITH ranked AS ({_ranked('documents', 'doc_id', columns=', text')})
SELECT rank // 32 AS batch_id,
  CAST(sum(least(octet_length(encode(text)) + 1, {L}) - 1) AS BIGINT) AS supervised
FROM ranked GROUP BY 1"""

_SQL["file_batches"] = f"""
WITH numbered AS (SELECT row_number() OVER (ORDER BY doc_id) AS line_no, text FROM documents),
ranked AS ({_ranked('numbered', 'line_no', columns=', text')})
SELECT rank // 32 AS batch_id,
  CAST(sum(least(octet_length(encode(text)) + 1, {L}) - 1) AS BIGINT) AS supervised
FROM ranked GROUP BY 1"""

_SQL["line_index"] = f"""
WITH {LINES}
SELECT line_no - 1 AS row_id,
  CAST(coalesce(sum(octet_length(encode(value)) + 1) OVER (
    ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset,
  CAST(octet_length(encode(value)) + 1 AS BIGINT) AS byte_len
FROM lines"""

_SQL["lookup_rows"] = """
SELECT doc_id, lang, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"""

_SQL["saved_tokenizer"] = f"""
WITH {_training()}
SELECT unnest(t) AS token, CAST(generate_subscripts(t, 1) - 1 AS INT) AS id,
  generate_subscripts(t, 1) <= {len(SPECIAL_TOKENS)} AS special
FROM named"""

_SQL["tokenizer_json"] = _SQL["saved_tokenizer"]

_SQL["lookup_lines"] = f"""
WITH {LINES}
SELECT value, count(*) AS lines FROM lines WHERE octet_length(encode(value)) + 1 > 512 GROUP BY value"""

# Projections and filters ----------------------------------------------------

_SQL["nonblank"] = f"""
SELECT doc_id, CAST(pos - 1 AS INT) AS pos, CAST(regexp_matches(piece, '\\S') AS INT) AS filled
FROM (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos
  FROM (SELECT doc_id, string_split(replace(text, '.', {NL}), {NL}) AS ps FROM documents))"""

_SQL["extract_text"] = f"WITH {RAW_TEXT} SELECT line_no, text FROM texts WHERE text IS NOT NULL"

CHUNKS = """
chunks AS (
  SELECT doc_id, lang, source, CAST(i AS INT) AS chunk_idx, substr(text, i * 512 + 1, 512) AS text
  FROM (SELECT *, unnest(range((length(text) + 511) // 512)) AS i FROM documents)
  WHERE regexp_matches(substr(text, i * 512 + 1, 512), '\\S'))
"""
_SQL["chunk_text"] = f"WITH {CHUNKS} SELECT doc_id, chunk_idx, text FROM chunks"

MAPPED = """
mapped AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, role, text AS content
  FROM conversations WHERE role IN ('user', 'assistant'))
"""
_SQL["map_roles"] = (
    f"WITH {MAPPED} SELECT conv_id, CAST(pos - 1 AS INT) AS pos, role, content FROM mapped"
)
_SYSTEM = _text(SYSTEM_PROMPT)
_SQL["prepend_system"] = f"""
WITH {MAPPED} SELECT conv_id, CAST(pos AS INT) AS pos, role, content FROM mapped
UNION ALL SELECT DISTINCT conv_id, 0, 'system', {_SYSTEM} FROM conversations
UNION ALL SELECT DISTINCT -1 - conv_id, 0, 'system', {_SYSTEM} FROM conversations"""
_SQL["to_chat"] = f"""
WITH {MAPPED} SELECT conv_id, CAST(pos AS INT) AS pos, role, content FROM mapped
UNION ALL SELECT DISTINCT conv_id, 0, 'system', {_SYSTEM} FROM mapped"""

_SQL["render_chat"] = f"""
WITH {RENDERED} SELECT conv_id, r AS rendered, r || '<|im_start|>assistant' || {NL} AS prompt
FROM rendered"""

_EXTRA = f"CASE WHEN item_id % 3 = 2 THEN {NL} || reverse(text) ELSE '' END"
_ANSWER = "text || CASE WHEN item_id % 5 = 0 THEN '?' ELSE '!' END"
_EXCHANGE = f"{_frame(_text('user'), f'text || {_EXTRA}')} || {_frame(_text('assistant'), _ANSWER)}"
_SQL["render_instruction"] = f"SELECT item_id, {_EXCHANGE} AS rendered FROM benchmark"

_ALL_TURNS = f"string_agg({_frame('role', 'text')}, '' ORDER BY turn)"
_SQL["render_messages"] = (
    f"SELECT conv_id, {_ALL_TURNS} AS rendered FROM conversations GROUP BY conv_id"
)

_SQL["render_fallback"] = f"""
SELECT doc_id, {_frame(_text('user'), '''CASE WHEN doc_id % 2 = 0 THEN text ELSE
  '{"doc_id": ' || doc_id || ', "lang": "' || lang || '", "info": ["' || source || '", "' || n_chars || '"]}' END''')}
  AS rendered FROM documents"""

_SQL["render_any"] = f"""
WITH {RENDERED}
SELECT 'i' || item_id AS id, {_EXCHANGE} AS rendered FROM benchmark
UNION ALL SELECT 'm' || conv_id, {_ALL_TURNS} FROM conversations GROUP BY conv_id
UNION ALL SELECT 'c' || conv_id, r FROM rendered
UNION ALL SELECT 'f' || doc_id,
  {_frame(_text('user'), '''('{"messages": [], "quality": ' || quality || '}')''')} FROM labels"""

_SQL["with_bos"] = "SELECT doc_id, '<|im_start|>' || text AS text FROM documents"

_SQL["truncate_pad"] = f"""
WITH {DOC_BYTES} SELECT doc_id, {_joined(_padded('ids', 0))} AS ids FROM doc_ids"""
_SQL["length_mask"] = f"""
WITH {DOC_BYTES} SELECT doc_id, {_joined(_bits('len(ids)'))} AS mask FROM doc_ids"""
_SQL["pad_value_mask"] = f"""
WITH {CHAT_BYTES} SELECT conv_id,
  {_joined(f"list_transform({_padded('ids', 4)}, lambda x: CAST(x <> 4 AS INT))")} AS mask
FROM chat_ids"""
_HEADER = [3, *[_IDS[b] for b in b"assistant\n"]]
_SQL["assistant_mask"] = f"""
WITH {CHAT_BYTES}, {_assistant_bits('chat_ids', str(_HEADER), len(_HEADER))}
SELECT conv_id, {_joined('mask')} AS mask FROM bits"""


def _shifted(key: str, padded: str, mask: str, source: str) -> str:
    return f"""
SELECT {key}, {_joined(f'p[1:{L - 1}]')} AS x, {_joined(f'p[2:{L}]')} AS y, {_joined(f'm[2:{L}]')} AS mask
FROM (SELECT {key}, {padded} AS p, {mask} AS m FROM {source})"""


_SQL["shift_xy"] = f"WITH {DOC_BYTES} " + _shifted(
    "doc_id", _padded("ids", 0), _bits("len(ids)"), "doc_ids"
)
_SQL["pretrain_samples"] = (
    f"WITH {_doc_coded()}, begun AS (SELECT doc_id, list_concat([3], ids) AS b FROM doc_ids)"
    + _shifted("doc_id", _padded("b", 0), _bits("len(b)"), "begun")
)
_CHAT_PADDED = f"padded AS (SELECT conv_id, {_padded('ids', 4)} AS ids FROM chat_ids)"
_SQL["sft_samples"] = f"WITH {_chat_coded()}, {_CHAT_PADDED}" + _shifted(
    "conv_id", "ids", "list_transform(ids, lambda x: CAST(x <> 4 AS INT))", "padded"
)
_SQL["sft_samples_assistant"] = (
    "WITH "
    + _chat_coded()
    + f""", {_CHAT_PADDED},
header AS (
  SELECT list_concat([3], list_transform(string_split({_merged(
      "array_to_string(" + _per_byte("'assistant'", BYTE_CHAR_LIST) + ", '')")}, ''),
    lambda c: unicode(c) - 256), {_byte_ids(NL)}) AS h),
pos AS (
  SELECT conv_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM padded),
opened AS (
  SELECT conv_id, id, p, CASE WHEN ids[p - len(h) : p - 1] = h AND p > len(h) THEN p END AS s
  FROM pos JOIN padded USING (conv_id), header),
bits AS (
  SELECT conv_id, list(CAST(coalesce(st > coalesce(en, -1) AND p <= last, false) AS INT) ORDER BY p) AS mask
  FROM (
    SELECT conv_id, p,
      max(s) OVER (PARTITION BY conv_id ORDER BY p) AS st,
      max(CASE WHEN id = 4 THEN p END) OVER (
        PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS en,
      max(CASE WHEN id = 4 THEN p END) OVER (PARTITION BY conv_id) AS last
    FROM opened)
  GROUP BY conv_id)"""
    + _shifted("conv_id", "ids", "mask", "(SELECT * FROM padded JOIN bits USING (conv_id))")
)

_SQL["take_lines"] = f"""
WITH {RAW} SELECT line_no, CAST(value = '' AS INT) AS is_empty FROM raw
ORDER BY line_no LIMIT 600"""

# Text and tokens ------------------------------------------------------------

_SQL["normalize_nfkc"] = "SELECT doc_id, text FROM documents"

_SQL["split_special"] = f"""
WITH chats AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k
  FROM conversations WHERE role IN ('system', 'user', 'assistant'))
SELECT conv_id, CAST(k * 4 AS INT) AS pos, '<|im_start|>' AS part, 1 AS special FROM chats
UNION ALL SELECT conv_id, CAST(k * 4 + 1 AS INT), role || {NL} || text, 0 FROM chats
UNION ALL SELECT conv_id, CAST(k * 4 + 2 AS INT), '<|im_end|>', 1 FROM chats
UNION ALL SELECT conv_id, CAST(k * 4 + 3 AS INT), {NL}, 0 FROM chats"""

_SQL["pretokenize"] = f"""
SELECT doc_id, CAST(len(ws) AS INT) AS words, md5(array_to_string(ws, '|')) AS digest,
  regexp_extract(CASE WHEN text LIKE ' %' THEN text ELSE ' ' || text END, {WORDS}) AS first_spaced
FROM (SELECT doc_id, text, regexp_extract_all(text, {WORDS}) AS ws FROM documents)"""

_SQL["byte_symbol_map"] = f"""
WITH {DOC_WORDS}
SELECT word, array_to_string({_per_byte('word', BYTE_SYMBOL_LIST)}, '') AS symbols, word AS back
FROM counts"""
_SQL["word_counts"] = f"WITH {DOC_WORDS} SELECT word, freq FROM counts"
_SQL["pair_counts"] = f"""
WITH {DOC_WORDS},
symbols AS (SELECT freq, {_per_byte('word', BYTE_SYMBOL_LIST)} AS s FROM counts)
SELECT pair[1] AS l, pair[2] AS r, CAST(sum(freq) AS BIGINT) AS n
FROM (SELECT unnest(list_transform(range(1, len(s)), lambda i: s[i:i + 1])) AS pair, freq FROM symbols)
GROUP BY 1, 2"""
_SQL["train_bpe"] = f"""
WITH {_training()}
SELECT CAST(i AS INT) AS rank, t[unicode(substr(merges[i + 1], 1, 1)) - 255] AS left,
  t[unicode(substr(merges[i + 1], 2, 1)) - 255] AS right
FROM hist, named, range(len(merges)) r(i)"""
_SQL["encode"] = f"""
WITH {_doc_coded()}
SELECT doc_id, CAST(len(ids) AS INT) AS tokens, {_joined('ids')} AS ids FROM doc_ids"""
_SQL["decode"] = f"""
WITH {RENDERED} SELECT conv_id, r AS decoded,
  replace(replace(r, '<|im_start|>', ''), '<|im_end|>', '') AS plain FROM rendered"""
_SQL["token_to_id"] = f"""
WITH {_training()},
vocab AS (SELECT unnest(t) AS token, generate_subscripts(t, 1) - 1 AS id FROM named),
asked AS (SELECT DISTINCT replace(word, ' ', 'Ġ') AS token FROM counts)
SELECT token, CAST(coalesce(id, 0) AS INT) AS id FROM asked LEFT JOIN vocab USING (token)"""

# Aggregations ---------------------------------------------------------------

_SQL["count_lines"] = f"WITH {LINES} SELECT count(*) AS lines FROM lines"
_SQL["count_samples"] = (
    f"WITH {CHUNKS} SELECT source, count(*) AS samples FROM chunks GROUP BY source"
)


def _profile(source: str) -> str:
    return f"""
SELECT lang, lines, rows, chars, chars // greatest(rows, 1) AS mean_chars FROM (
  SELECT lang, count(*) AS lines, count(nullif(text, '')) AS rows,
    CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars
  FROM {source} GROUP BY lang)"""


_SQL["chunk_profile"] = f"WITH {CHUNKS} {_profile('chunks')}"
_SQL["corpus_profile"] = (
    f"WITH {RAW_TEXT} {_profile('(SELECT * FROM texts WHERE line_no <= 600)')}"
)
_SQL["scan_report"] = f"""
WITH {RAW_TEXT}
SELECT CASE
    WHEN NOT regexp_matches(value, '\\S') THEN 'blank_line'
    WHEN NOT json_valid(value) THEN 'malformed'
    WHEN json_type(value, '$.text') IS NULL THEN 'missing_text'
    WHEN json_type(value, '$.text') = 'NULL' THEN 'empty_text'
    WHEN json_type(value, '$.text') <> 'VARCHAR' THEN 'non_string'
    WHEN text IS NULL THEN 'empty_text'
    WHEN NOT regexp_matches(text, '\\S') THEN 'blank_text'
    ELSE 'kept' END AS reason, count(*) AS lines
FROM texts GROUP BY 1"""

_WORD_CODED = ",\n".join(
    [
        _training(),
        "word_occ AS (SELECT word, 1 AS place, word AS w, CAST(NULL AS INT) AS special FROM counts)",
        _coded("word_occ", "word", "word"),
    ]
)
_COVERED = """
covered AS (
  SELECT word, CAST(len(ids) AS INT) AS tokens, CAST(length(word) AS INT) AS chars FROM word_ids)
"""
_SQL["coverage"] = f"""
WITH {_WORD_CODED}, {_COVERED}
SELECT word, tokens, chars, round(chars / greatest(tokens, 1), 6) AS chars_per_token,
  CASE WHEN tokens = 1 THEN '1' WHEN tokens <= 3 THEN '2-3' ELSE '>3' END AS token_class
FROM covered"""
_DOC_TOTALS = """
totals AS (SELECT lang, source, CAST(len(ids) AS BIGINT) AS n, length(text) AS c
  FROM documents JOIN doc_ids USING (doc_id))
"""
_SQL["coverage_summary"] = f"""
WITH {_doc_coded()}, {_DOC_TOTALS}
SELECT lang, count(*) AS words, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(c) AS BIGINT) AS chars,
  round(sum(c) / sum(n), 6) AS chars_per_token FROM totals GROUP BY lang"""
# The bytes of each token, in hex, and the text of ids.
_TOKEN_HEX = f"""
token_hex AS MATERIALIZED (SELECT list_transform(t, lambda x: array_to_string(list_transform(string_split(x, ''),
  lambda c: printf('%02X', list_position([{', '.join(map(_text, SYMBOLS))}], c) - 1)), '')) AS h FROM named)
"""


def _back(ids: str) -> str:
    return f"decode(unhex(array_to_string(list_transform({ids}, lambda i: h[i + 1]), '')))"


def _stripped(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


_TRIPS = f"""
trips AS (
  SELECT documents.lang, len(ids) AS n,
    CAST({_stripped(_back('list_filter(ids, lambda i: i > 4)'))} = {_stripped('text')} AS INT) AS same
  FROM documents JOIN doc_ids USING (doc_id), token_hex)
"""
_SQL["round_trip"] = f"""
WITH {_doc_coded()}, {_TOKEN_HEX}, {_TRIPS}
SELECT lang, count(*) AS texts, CAST(sum(n) AS BIGINT) AS tokens, avg(same) AS round_trip
FROM trips GROUP BY lang"""
_LISTED = f"[{', '.join(map(_text, SPECIAL_TOKENS))}]"
_SQL["special_retention"] = f"""
WITH {_chat_coded()}, {RENDERED}, {_TOKEN_HEX},
framed AS (
  SELECT conv_id, '<s>' || r || '</s>' AS text, list_concat([1], ids, [2]) AS ids
  FROM rendered JOIN chat_ids USING (conv_id)),
back AS (SELECT conv_id, text, ids, {_back('ids')} AS back FROM framed, token_hex)
SELECT conv_id, CAST(len(ids) AS INT) AS tokens,
  array_to_string(list_filter({_LISTED}, lambda s: contains(text, s)), ' ') AS present,
  array_to_string(list_filter({_LISTED}, lambda s: contains(text, s) AND contains(back, s)), ' ') AS kept
FROM back"""
_PROMPT = (
    "UNION ALL SELECT DISTINCT conv_id, 1000000, '<|im_start|>', 3 FROM chats "
    f"UNION ALL SELECT DISTINCT conv_id, 1000001, 'assistant' || {NL}, NULL FROM chats"
)
_CHECKED = """
checked AS (SELECT conv_id, CAST(least(len(ids), 256) AS INT) AS tokens,
  CAST(list_contains(ids[1:256], 3) AND list_contains(ids[1:256], 4) AS INT) AS frames_kept
  FROM chat_ids)
"""
_SQL["chat_check"] = f"""
WITH {_chat_coded(_PROMPT)}, {_CHECKED} SELECT conv_id, tokens, frames_kept FROM checked"""
_SQL["oov_rate"] = f"""
WITH {_doc_coded()}
SELECT source, count(*) AS words, avg(CAST(list_contains(ids, 0) AS INT)) AS oov
FROM documents JOIN doc_ids USING (doc_id) GROUP BY source"""

_SQL["tokenizer_report"] = f"""
WITH {_chat_coded(_PROMPT)}, {_CHECKED},
doc_occ AS (SELECT doc_id, pos AS place, w, CAST(NULL AS INT) AS special FROM doc_words),
{_coded("doc_occ", "doc_id", "doc")}, {_DOC_TOTALS},
word_occ AS (SELECT word, 1 AS place, word AS w, CAST(NULL AS INT) AS special FROM counts),
{_coded("word_occ", "word", "word")}, {_COVERED}, {_TOKEN_HEX}, {_TRIPS},
report AS (
  SELECT 'vocab_size' AS metric, 'all' AS "group", CAST(len(t) AS DOUBLE) AS value FROM named
  UNION ALL SELECT 'special_id', t[i], i - 1 FROM named, range(2, 6) r(i)
  UNION ALL SELECT 'texts', lang, count(*) FROM totals GROUP BY lang
  UNION ALL SELECT 'tokens', lang, sum(n) FROM totals GROUP BY lang
  UNION ALL SELECT 'round_trip', lang, avg(same) FROM trips GROUP BY lang
  UNION ALL SELECT 'specials_present', 'all', sum(len(list_filter({_LISTED}, lambda s: contains(text, s)))) FROM documents
  UNION ALL SELECT 'specials_kept', 'all', sum(len(list_filter({_LISTED}, lambda s: contains(text, s)
    AND contains({_back('ids')}, s)))) FROM documents JOIN doc_ids USING (doc_id), token_hex
  UNION ALL SELECT 'chat_tokens', 'all', sum(tokens) FROM checked
  UNION ALL SELECT 'chat_frames_kept', 'all', avg(frames_kept) FROM checked
  UNION ALL SELECT 'words_by_class',
    CASE WHEN tokens = 1 THEN '1' WHEN tokens <= 3 THEN '2-3' ELSE '>3' END, count(*)
    FROM covered GROUP BY 2
  UNION ALL SELECT 'word_tokens', 'all', sum(tokens) FROM covered
  UNION ALL SELECT 'word_chars', 'all', sum(chars) FROM covered
  UNION ALL SELECT 'chars_per_token', 'all', sum(chars) / sum(tokens) FROM covered
  UNION ALL SELECT 'words', 'all', count(*) FROM covered
  UNION ALL SELECT 'oov', 'all', avg(CAST(list_contains(ids, 0) AS INT)) FROM word_ids)
SELECT metric, "group", round(value, 6) AS value FROM report"""

_SQL["supervised_tokens"] = f"""
WITH {_chat_coded()}, {_CHAT_PADDED},
ranked AS ({_ranked('padded', 'conv_id', columns=', ids')})
SELECT rank // 24 AS batch_id,
  CAST(sum(len(list_filter(ids[2:], lambda x: x <> 4))) AS BIGINT) AS supervised
FROM ranked GROUP BY 1"""

# Order and batches ----------------------------------------------------------

_SQL["epoch_order"] = f"""
SELECT 0 AS epoch, doc_id, rank FROM ({_ranked('documents', 'doc_id', 0)})
UNION ALL SELECT 1, doc_id, rank FROM ({_ranked('documents', 'doc_id', 1)})"""
_SQL["epoch_batches"] = f"""
WITH ranked AS ({_ranked('documents', 'doc_id', columns=', lang')}),
total AS (SELECT least((count(*) + 47) // 48, 200) AS b FROM documents)
SELECT doc_id, lang, rank, rank // 48 AS batch_id, rank // 192 AS update_id,
  CAST(rank // 192 < b // 4 AS INT) AS applied
FROM ranked, total WHERE rank // 48 < 200"""
_SQL["text_batches"] = f"""
WITH {RAW_TEXT},
valid AS (SELECT line_no, row_number() OVER (ORDER BY line_no) - 1 AS rank
  FROM texts WHERE regexp_matches(text, '\\S'))
SELECT line_no, rank, rank // 100 AS batch_id FROM valid"""
_SQL["stream_prepare_pretrain"] = f"""
WITH {RAW_TEXT}
SELECT CAST(i AS INT) AS chunk_idx, substr(text, i * 512 + 1, 512) AS text
FROM (SELECT text, unnest(range((length(text) + 511) // 512)) AS i FROM texts)
WHERE regexp_matches(substr(text, i * 512 + 1, 512), '\\S')"""
_SQL["stream_prepare_chat"] = f"""
SELECT {_frame("'system'", _SYSTEM)} || string_agg({_frame('role', 'text')}, '' ORDER BY turn) AS rendered
FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id"""
_SQL["sql_functions"] = f"""
WITH {RENDERED}, {CHAT_BYTES}, {_assistant_bits('chat_ids', str(_HEADER), len(_HEADER))}
SELECT conv_id, r AS rendered,
  CAST(len(list_filter(range((length(r) + 99) // 100),
    lambda i: regexp_matches(substr(r, i * 100 + 1, 100), '\\S'))) AS INT) AS pieces,
  {_joined('mask')} AS mask
FROM rendered JOIN bits USING (conv_id)"""


def all_sql() -> dict[str, str]:
    recursive = {k: v.replace("WITH", "WITH RECURSIVE", 1) for k, v in _SQL.items() if "USING KEY" in v}
    return _SQL | recursive
