"""Plain SQL for the registered queries, for a check by another engine over the same tables."""

from __future__ import annotations

from textloom.functions.text import SYSTEM_CLOSE, SYSTEM_OPEN, WHITESPACE
from textloom.plans import registry as R

PATTERN = R.SPECIALS.pattern
SYSTEM_BLOCK = SYSTEM_OPEN + R.SYSTEM_PROMPT + SYSTEM_CLOSE


def _with(*ctes: str) -> str:
    """Name each of the given CTEs once, in order."""
    return "WITH RECURSIVE " + ",\n".join(dict.fromkeys(ctes)) + "\n"


def _digest_ids(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


# ---- documents -----------------------------------------------------------------------------

CORPUS = """corpus AS (
  SELECT doc_id, text, lang, source, n_chars,
         CASE WHEN p < border THEN 'validation' ELSE 'train' END AS split,
         CASE WHEN p < border THEN p ELSE p - border END AS pos
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS p,
               round_even(count(*) OVER ()::DOUBLE * 5 / 100, 0)::BIGINT AS border
        FROM documents))"""

LEXED = f"""lexed AS (
  SELECT doc_id, split, pos, regexp_extract_all(text, '{PATTERN}') AS toks FROM corpus)"""

TOKENS = """tokens AS (
  SELECT doc_id, split, pos, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM lexed)"""

VOCAB = """vocab AS (
  SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) + 2 AS id
  FROM tokens WHERE token NOT IN ('<unk>', '<s>', '</s>') GROUP BY token)"""


ENCODED = """encoded AS (
  SELECT t.doc_id, t.split, t.pos, t.i,
         CASE t.token WHEN '<s>' THEN 1 WHEN '</s>' THEN 2 ELSE coalesce(v.id, 0) END AS id
  FROM tokens t LEFT JOIN vocab v ON v.token = t.token)"""


ROWS = """ids AS (
  SELECT c.doc_id, c.split, c.pos, coalesce(e.ids, []) AS ids
  FROM corpus c LEFT JOIN (SELECT doc_id, list(id ORDER BY i) AS ids FROM encoded GROUP BY doc_id) e
  USING (doc_id))"""

DOCS = (CORPUS, LEXED, TOKENS, VOCAB)
DOC_IDS = (*DOCS, ENCODED, ROWS)


def _blocks(batch: str) -> str:
    return f"""blocks AS (
  SELECT split, batch_id, off // {R.BLOCK_SIZE} AS block_id, list(id ORDER BY off) AS ids
  FROM (SELECT split, batch_id, id,
               row_number() OVER (PARTITION BY split, batch_id ORDER BY pos, i) - 1 AS off,
               count(*) OVER (PARTITION BY split, batch_id) AS total
        FROM (SELECT *, {batch} AS batch_id FROM encoded))
  WHERE off < total - total % {R.BLOCK_SIZE}
  GROUP BY split, batch_id, off // {R.BLOCK_SIZE})"""


BLOCKS = (*DOCS, ENCODED, _blocks(f"pos // {R.BATCH_SIZE}"))
WHOLE = (*DOCS, ENCODED, _blocks("0"))
BLOCK_ROWS = f"""SELECT split, batch_id, block_id, {_digest_ids('ids')} AS ids_md5,
  len(ids)::BIGINT AS n_ids FROM blocks"""
ALL_AS_TRAIN = CORPUS.replace("CASE WHEN p < border THEN 'validation' ELSE 'train' END", "'train'").replace(
    "CASE WHEN p < border THEN p ELSE p - border END", "p"
)
STREAM = (ALL_AS_TRAIN, *DOCS[1:], ENCODED, _blocks(f"pos // {R.BATCH_SIZE}"))
BATCHES = f"""batch_totals AS (
  SELECT split, pos // {R.BATCH_SIZE} AS batch_id, sum(len(ids))::BIGINT AS tokens
  FROM ids GROUP BY split, pos // {R.BATCH_SIZE})"""

DOC_TOKENS = f"SELECT doc_id, {_digest_ids('ids')} AS ids_md5, len(ids)::BIGINT AS n_ids FROM ids"

# ---- dialogs -------------------------------------------------------------------------------

CONVS = """convs AS (
  SELECT conv_id,
         CASE WHEN p < border THEN 'validation' ELSE 'train' END AS split,
         CASE WHEN p < border THEN p ELSE p - border END AS pos
  FROM (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS p,
               round_even(count(*) OVER ()::DOUBLE * 5 / 100, 0)::BIGINT AS border
        FROM (SELECT DISTINCT conv_id FROM conversations)))"""

TURNS = """turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)"""


def _prompt(system: str, order: str, index: str) -> str:
    return f"""'<s>[INST] ' || '{system}' || string_agg(
    CASE WHEN role = 'user'
         THEN (CASE WHEN {index} > 0 THEN '<s>[INST] ' ELSE '' END) || text || ' [/INST]'
         ELSE ' ' || text || ' </s>' END, '' ORDER BY {order})"""


def _prompts(system: str) -> str:
    return f"""prompts AS (
  SELECT conv_id, {_prompt(system, 'i', 'i')} AS text FROM turns GROUP BY conv_id)"""


LENGTHS = f"""lengths AS (
  SELECT c.split, c.pos, c.conv_id,
         least(len(regexp_extract_all(p.text, '{PATTERN}')), {R.MAX_LENGTH})::BIGINT AS length
  FROM convs c JOIN prompts p USING (conv_id))"""

RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY length DESC, pos) - 1 AS rank FROM lengths)"""

# One conversation is placed per step: the next filler if it fits, else the next opener.
PACKS = f"""sorted AS (
  SELECT split, list(length ORDER BY rank) AS ls,
         (SELECT len(regexp_extract_all('{SYSTEM_BLOCK}', '{PATTERN}')) + 1) AS sys
  FROM ranked GROUP BY split),
steps AS (
  SELECT split, 1::BIGINT AS lo, len(ls)::BIGINT - 1 AS hi, 0::BIGINT AS pack_id, 0::BIGINT AS slot,
         ls[1] AS used, 0::BIGINT AS rank
  FROM sorted
  UNION ALL
  SELECT split,
         CASE WHEN fits THEN lo ELSE lo + 1 END,
         CASE WHEN fits THEN hi - 1 ELSE hi END,
         CASE WHEN fits THEN pack_id ELSE pack_id + 1 END,
         CASE WHEN fits THEN slot + 1 ELSE 0 END,
         CASE WHEN fits THEN used + ls[hi + 1] ELSE ls[lo + 1] END,
         CASE WHEN fits THEN hi ELSE lo END
  FROM (SELECT s.*, l.ls, used + l.ls[hi + 1] + l.sys <= {R.MAX_LENGTH} AS fits
        FROM steps s JOIN sorted l USING (split) WHERE lo <= hi)),
packs AS (
  SELECT r.split, r.pos, r.conv_id, r.length, s.pack_id, s.slot
  FROM ranked r JOIN steps s ON s.split = r.split AND s.rank = r.rank)"""

PACKED = (CONVS, TURNS, _prompts(""), LENGTHS, RANKED, PACKS)

SAMPLES = f"""pack_turns AS (
  SELECT p.split, p.pack_id, t.role, t.text,
         row_number() OVER (PARTITION BY p.split, p.pack_id ORDER BY p.slot, t.i) - 1 AS nth
  FROM packs p JOIN turns t USING (conv_id)),
pack_prompts AS (
  SELECT split, pack_id AS pos, {_prompt(SYSTEM_BLOCK, 'nth', 'nth')} AS text
  FROM pack_turns GROUP BY split, pack_id),
system_prompts AS (
  SELECT conv_id, {_prompt(SYSTEM_BLOCK, 'i', 'i')} AS text FROM turns GROUP BY conv_id),
chat_vocab AS (
  SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 2 AS id
  FROM (SELECT unnest(regexp_extract_all(text, '{PATTERN}')) AS token FROM system_prompts)
  WHERE token NOT IN ('<unk>', '<s>', '</s>') GROUP BY token),
chat_lexed AS (
  SELECT split, pos, list_slice(regexp_extract_all(text, '{PATTERN}'), 1, {R.MAX_LENGTH}) AS toks
  FROM pack_prompts),
chat_tokens AS (
  SELECT split, pos, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS i FROM chat_lexed),
samples AS (
  SELECT t.split, t.pos, list(
    CASE t.token WHEN '<s>' THEN 1 WHEN '</s>' THEN 2 ELSE coalesce(v.id, 0) END ORDER BY t.i) AS ids
  FROM chat_tokens t LEFT JOIN chat_vocab v ON v.token = t.token
  GROUP BY t.split, t.pos)"""


def _collated(rows: str) -> str:
    """One row per padded token; ``lab0`` is the label before anything is restored."""
    return f"""batched AS (
  SELECT split, pos, pos // {R.TRAIN_BATCH} AS batch_no, ids,
         max(len(ids)) OVER (PARTITION BY split, pos // {R.TRAIN_BATCH}) AS longest FROM {rows}),
cells AS (
  SELECT split, pos, batch_no, i, coalesce(ids[i + 1], 2) AS id,
         CASE WHEN i < len(ids) THEN 1 ELSE 0 END AS att,
         CASE WHEN coalesce(ids[i + 1], 2) = 2 THEN -100 ELSE ids[i + 1] END AS lab0
  FROM (SELECT *, unnest(range(longest)) AS i FROM batched))"""


RESTORED = """restored AS (
  SELECT c.split, c.pos, c.batch_no, c.i, c.id, c.lab0,
         CASE WHEN back THEN 1 ELSE att END AS att, CASE WHEN back THEN 2 ELSE lab0 END AS lab
  FROM (SELECT *, coalesce(lab0 = -100 AND i <= 1 + max(CASE WHEN lab0 <> -100 THEN i END)
                           OVER (PARTITION BY split, pos), FALSE) AS back FROM cells) c)"""

MASKED = """marker AS (
  SELECT coalesce((SELECT id FROM chat_vocab WHERE token = '['), 0) AS m0,
         coalesce((SELECT id FROM chat_vocab WHERE token = '/'), 0) AS m1,
         coalesce((SELECT id FROM chat_vocab WHERE token = 'INST'), 0) AS m2,
         coalesce((SELECT id FROM chat_vocab WHERE token = ']'), 0) AS m3),
ahead AS (
  SELECT *, lead(lab, 1) OVER w AS l1, lead(lab, 2) OVER w AS l2, lead(lab, 3) OVER w AS l3
  FROM restored WINDOW w AS (PARTITION BY split, pos ORDER BY i)),
starts AS (
  SELECT split, pos, i + 4 AS begin, row_number() OVER (PARTITION BY split, pos ORDER BY i) AS k
  FROM ahead, marker WHERE lab = m0 AND l1 = m1 AND l2 = m2 AND l3 = m3),
ends AS (
  SELECT split, pos, i + 1 AS stop, row_number() OVER (PARTITION BY split, pos ORDER BY i) AS k
  FROM restored WHERE lab = 2),
spans AS (SELECT s.split, s.pos, s.begin, e.stop FROM starts s JOIN ends e USING (split, pos, k)),
formed AS (
  SELECT b.split, b.pos, b.batch_no,
         coalesce(s.n, 0) = coalesce(e.n, 0) AS well_formed
  FROM batched b
  LEFT JOIN (SELECT split, pos, count(*) AS n FROM starts GROUP BY split, pos) s USING (split, pos)
  LEFT JOIN (SELECT split, pos, count(*) AS n FROM ends GROUP BY split, pos) e USING (split, pos)),
masked AS (
  SELECT r.split, r.pos, r.batch_no, r.i, r.id, r.att, f.well_formed,
         CASE WHEN EXISTS (SELECT 1 FROM spans x WHERE x.split = r.split AND x.pos = r.pos
                           AND r.i >= x.begin AND r.i < x.stop) THEN r.lab ELSE -100 END AS lab
  FROM restored r JOIN formed f USING (split, pos))"""


def _batch_rows(table: str, label: str, more: str = "", where: str = "") -> str:
    return f"""SELECT split, pos, batch_no,
  md5(array_to_string(list(id ORDER BY i), ',')) AS ids_md5,
  md5(array_to_string(list(att ORDER BY i), ',')) AS attention_md5,
  md5(array_to_string(list({label} ORDER BY i), ',')) AS labels_md5,
  count(*) AS n_ids{', any_value(' + more + ') AS ' + more if more else ''}
  FROM {table} {where} GROUP BY split, pos, batch_no"""


CHAT = (*PACKED, SAMPLES)
CHAT_BATCHES = (*CHAT, _collated("samples"), RESTORED)

INSTRUCT = """turns_asked AS (
  SELECT u.conv_id, u.turn, u.role, u.text AS instruction, a.text AS response,
         CASE WHEN u.conv_id % 5 = 0 THEN '' ELSE n.text END AS context
  FROM conversations u
  LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations n ON n.conv_id = u.conv_id AND n.turn = u.turn + 2),
instruct AS (SELECT * FROM turns_asked WHERE role = 'user')"""

FROM_INSTRUCT = """SELECT conv_id, turn, 'instruct' AS source,
  md5('user:' || instruction || CASE WHEN context <> '' THEN ' ' || context ELSE '' END
      || coalesce('|assistant:' || response, '')) AS dialog_md5, 2::BIGINT AS turns FROM instruct"""

FROM_ALPACA = """SELECT conv_id, turn, 'alpaca' AS source,
  md5('user:' || instruction || coalesce('|assistant:' || response, '')) AS dialog_md5, 2::BIGINT AS turns
  FROM instruct"""

TRANSCRIPTS = f"""transcripts AS (
  SELECT conv_id, '{R.TRANSCRIPT_SYSTEM}' || chr(10) || string_agg(
    CASE role WHEN 'user' THEN '[|Human|] ' WHEN 'assistant' THEN '[|AI|] ' ELSE '' END
    || text || chr(10), '' ORDER BY turn) AS input
  FROM conversations GROUP BY conv_id),
pieces AS (
  SELECT conv_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i
  FROM (SELECT conv_id, list_filter(list_transform(
          string_split(replace(input, '{R.TRANSCRIPT_SYSTEM}', ''), '[|Human|]'),
          lambda p: trim(p, '{WHITESPACE}')), lambda p: p <> '') AS ps FROM transcripts)),
halves AS (
  SELECT conv_id, i, string_split(piece, '[|AI|]')[1] AS question,
         substr(piece, strpos(piece, '[|AI|]') + 6) AS answer
  FROM pieces WHERE contains(piece, '[|AI|]'))"""

FROM_TRANSCRIPT = f"""SELECT t.conv_id, 'transcript' AS source,
  md5(coalesce(string_agg('user:' || trim(h.question, '{WHITESPACE}') || '|assistant:'
      || trim(h.answer, '{WHITESPACE}'), '|' ORDER BY h.i), '')) AS dialog_md5,
  (2 * count(h.i))::BIGINT AS turns
  FROM transcripts t LEFT JOIN halves h USING (conv_id) GROUP BY t.conv_id"""

FROM_TURNS = """SELECT conv_id, 'conversations' AS source,
  md5(string_agg(role || ':' || text, '|' ORDER BY turn)) AS dialog_md5, count(*) AS turns
  FROM conversations GROUP BY conv_id"""

MERGED = f"""merged AS (
  SELECT conv_id, source_ord, source, dialog_md5, turns,
         row_number() OVER (ORDER BY source_ord, conv_id, turn) - 1 AS pos
  FROM (
    SELECT conv_id, turn, 0 AS source_ord, source, dialog_md5, turns FROM ({FROM_INSTRUCT})
    UNION ALL
    SELECT conv_id, NULL, 1, source, dialog_md5, turns FROM ({FROM_TRANSCRIPT})
    UNION ALL
    SELECT conv_id, turn, 2, source, dialog_md5, turns FROM ({FROM_ALPACA})))"""

# Turns that are no instruction, for two of the sets, and pieces of transcripts without an answer.
REJECTS = """rejects AS (
  SELECT 'instruct' AS source, count(*) AS rejects FROM turns_asked WHERE role <> 'user'
  UNION ALL
  SELECT 'alpaca', count(*) FROM turns_asked WHERE role <> 'user'
  UNION ALL
  SELECT 'transcript', count(*) FROM pieces WHERE NOT contains(piece, '[|AI|]'))"""

FILE_ROWS = """SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS pos,
  md5(text) AS text_md5, length(text)::BIGINT AS n
FROM (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split FROM documents)"""

HEAD = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY batch_id, block_id) - 1 AS pos FROM blocks)"""

CAPS = f"CASE split WHEN 'train' THEN {R.HEAD_TRAIN} ELSE {R.HEAD_VALIDATION} END"

ORACLES: dict[str, str] = {
    "load_corpus": """SELECT doc_id, 'train' AS split, row_number() OVER (ORDER BY doc_id) - 1 AS pos,
      md5(text) AS text_md5 FROM documents""",
    "load_corpus_config": """SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 'long' ELSE 'short' END AS config,
      CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, md5(text) AS text_md5
      FROM documents""",
    "load_files_csv": FILE_ROWS,
    "load_files_json": FILE_ROWS,
    "load_files_text": """SELECT split, row_number() OVER (PARTITION BY split ORDER BY doc_id, i) - 1 AS pos,
        md5(line || chr(10)) AS line_md5, (length(line) + 1)::BIGINT AS n
      FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split,
                   unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
    "prepared_roundtrip": _with(*BLOCKS) + BLOCK_ROWS,
    "text_column_pick": """SELECT item_id, md5(text) AS named_md5, md5(text) AS first_md5
      FROM benchmark""",
    "publish_roundtrip": FROM_TURNS,
    "global_position": """SELECT lang, n_chars, doc_id,
      row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) - 1 AS pos FROM documents""",
    "position_nullable_part": """SELECT nullif(lang, 'de') AS part, n_chars, doc_id,
      row_number() OVER (PARTITION BY nullif(lang, 'de') ORDER BY n_chars DESC, doc_id) - 1 AS pos
      FROM documents""",
    "token_offsets": _with(CORPUS, LEXED)
    + """SELECT split, pos, (sum(len(toks)) OVER (PARTITION BY split ORDER BY pos) - len(toks))::BIGINT
      AS start FROM lexed""",
    "head_percent_split": _with(CORPUS) + "SELECT doc_id, split, pos FROM corpus",
    "presplit_override": """WITH train AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p,
               round_even(count(*) OVER ()::DOUBLE * 25 / 100, 0)::BIGINT AS border
        FROM documents WHERE doc_id % 10 > 1)
      SELECT CASE WHEN p < border THEN 'validation' ELSE 'train' END AS split, doc_id,
             CASE WHEN p < border THEN p ELSE p - border END AS pos FROM train
      UNION ALL
      SELECT 'test', doc_id, row_number() OVER (ORDER BY doc_id) - 1
      FROM documents WHERE doc_id % 10 = 1""",
    "head_samples": _with(*BLOCKS, HEAD)
    + BLOCK_ROWS.replace("FROM blocks", f"FROM numbered WHERE pos < {CAPS}"),
    "dialog_from_instruct": _with(INSTRUCT) + FROM_INSTRUCT,
    "dialog_from_alpaca": _with(INSTRUCT) + FROM_ALPACA,
    "dialog_from_transcript": _with(TRANSCRIPTS) + FROM_TRANSCRIPT,
    "dialog_from_turns": FROM_TURNS,
    "dialog_concat": _with(INSTRUCT, TRANSCRIPTS, MERGED) + "SELECT * FROM merged",
    "dialog_sizes": _with(INSTRUCT, TRANSCRIPTS, MERGED, REJECTS)
    + """SELECT coalesce(m.source, 'total') AS source, count(*) AS rows,
        (SELECT sum(rejects)::BIGINT FROM rejects r WHERE m.source IS NULL OR r.source = m.source) AS rejects
      FROM merged m GROUP BY ROLLUP (m.source)""",
    "build_vocab": _with(*DOCS) + "SELECT token, n, id FROM vocab",
    "tokenize_docs": _with(*DOC_IDS) + DOC_TOKENS,
    "tokenize_small_head": _with(*DOC_IDS) + DOC_TOKENS,
    "tokenize_truncated": _with(*DOC_IDS)
    + f"""SELECT doc_id, md5(array_to_string(list_slice(ids, 1, {R.TRUNCATE_AT}), ',')) AS ids_md5,
      least(len(ids), {R.TRUNCATE_AT})::BIGINT AS n_ids FROM ids""",
    "tokenize_with_bos": _with(*DOC_IDS)
    + """SELECT doc_id, md5(array_to_string(list_concat([1], ids), ',')) AS ids_md5,
      len(ids)::BIGINT + 1 AS n_ids FROM ids""",
    "dialog_lengths": _with(CONVS, TURNS, _prompts(""), LENGTHS) + "SELECT split, pos, length FROM lengths",
    "system_prompt_size": f"""SELECT conv_id, turn,
      (len(regexp_extract_all('{SYSTEM_OPEN}' || text || '{SYSTEM_CLOSE}', '{PATTERN}')) + 1)::BIGINT AS tokens
      FROM conversations WHERE role = 'system'""",
    "row_batches": _with(CORPUS)
    + f""", counts AS (SELECT split, count(*) AS n FROM corpus GROUP BY split),
      shards AS (
        SELECT split, i, i * (n // k) + least(i, n % k) AS lo,
               (i + 1) * (n // k) + least(i + 1, n % k) AS hi
        FROM (SELECT split, n, least({R.SHARDS}, n) AS k, unnest(range(least({R.SHARDS}, n))) AS i FROM counts)),
      bases AS (
        SELECT *, coalesce(sum(ceil((hi - lo) / {R.BATCH_SIZE}.0)) OVER (
          PARTITION BY split ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
        FROM shards)
      SELECT c.doc_id, c.split, c.pos, b.base + (c.pos - b.lo) // {R.BATCH_SIZE} AS batch_id
      FROM corpus c JOIN bases b ON b.split = c.split AND c.pos >= b.lo AND c.pos < b.hi""".replace(
        ", counts", ",\ncounts", 1
    ),
    "group_texts": _with(*BLOCKS)
    + f"""SELECT split, batch_id, block_id, {_digest_ids('ids')} AS ids_md5,
      {_digest_ids('ids')} AS labels_md5, len(ids)::BIGINT AS n_ids FROM blocks""",
    "group_texts_whole": _with(*WHOLE) + BLOCK_ROWS.replace("batch_id,", "batch_id::BIGINT AS batch_id,"),
    "block_remainder": _with(*DOC_IDS, BATCHES)
    + f"""SELECT split, batch_id, tokens, tokens % {R.BLOCK_SIZE} AS dropped,
      tokens - tokens % {R.BLOCK_SIZE} AS kept FROM batch_totals""",
    "render_prompt": _with(TURNS, _prompts(SYSTEM_BLOCK))
    + "SELECT conv_id, md5(text) AS text_md5, length(text)::BIGINT AS n FROM prompts",
    "render_prompt_nosys": _with(TURNS, _prompts(""))
    + "SELECT conv_id, md5(text) AS text_md5, length(text)::BIGINT AS n FROM prompts",
    "length_rank": _with(CONVS, TURNS, _prompts(""), LENGTHS, RANKED)
    + "SELECT split, pos, length, rank FROM ranked",
    "pack_dialogs": _with(*PACKED) + "SELECT split, pos, length, pack_id, slot FROM packs",
    "merge_packs": _with(*PACKED)
    + """SELECT p.split, p.pack_id,
      md5(string_agg(t.role || ':' || t.text, '|' ORDER BY p.slot, t.turn)) AS dialog_md5,
      count(*) AS turns
      FROM packs p JOIN conversations t USING (conv_id) GROUP BY p.split, p.pack_id""",
    "pack_violations": _with(*PACKED)
    + f"""SELECT split, count(*) AS packs, max(tokens)::BIGINT AS most_tokens,
      count(*) FILTER (WHERE tokens > {R.MAX_LENGTH}) AS violations
      FROM (SELECT split, pack_id, sum(length) AS tokens FROM packs GROUP BY split, pack_id)
      GROUP BY split""",
    "pack_coverage": _with(*PACKED)
    + """SELECT split, count(*) AS rows, count(*) FILTER (WHERE times = 0) AS missing,
      count(*) FILTER (WHERE times > 1) AS repeated
      FROM (SELECT l.split, l.pos, count(p.pos) AS times
            FROM lengths l LEFT JOIN packs p ON p.split = l.split AND p.pos = l.pos
            GROUP BY l.split, l.pos) GROUP BY split""",
    "pack_report": _with(*PACKED)
    + f"""SELECT split, count(*) AS rows_before, count(*) FILTER (WHERE slot = 0) AS rows_after,
      sum(length)::BIGINT AS tokens,
      round(sum(length)::DOUBLE / (count(*) FILTER (WHERE slot = 0) * {R.MAX_LENGTH}), 6) AS fill_ratio
      FROM packs GROUP BY split""",
    "chat_samples": _with(*CHAT)
    + f"SELECT split, pos, {_digest_ids('ids')} AS ids_md5, len(ids)::BIGINT AS n_ids FROM samples",
    "collate_causal": _with(
        *DOC_IDS,
        _collated("ids"),
    )
    + _batch_rows("cells", "lab0"),
    "restore_eos": _with(*CHAT_BATCHES) + _batch_rows("restored", "lab"),
    "response_mask": _with(*CHAT_BATCHES, MASKED) + _batch_rows("masked", "lab", "well_formed"),
    "mismatch_filter": _with(*CHAT_BATCHES, MASKED)
    + _batch_rows("masked", "lab", where="WHERE well_formed"),
    "mismatch_counts": _with(*CHAT_BATCHES, MASKED)
    + """SELECT split, batch_no, count(*) AS rows, count(*) FILTER (WHERE NOT well_formed) AS failed
      FROM formed GROUP BY split, batch_no""",
    "perplexity_by_lang": f"""WITH words AS (
        SELECT lang, unnest(regexp_extract_all(text, '{PATTERN}')) AS token FROM documents),
      overall AS (SELECT token, count(*) AS n FROM words GROUP BY token),
      scale AS (SELECT sum(n)::DOUBLE + count(*) AS total FROM overall),
      scored AS (
        SELECT w.lang, -ln((o.n + 1) / s.total) AS nll
        FROM words w JOIN overall o USING (token), scale s)
      SELECT lang, count(*) AS tokens, round(exp(avg(nll)), 4) AS perplexity FROM scored GROUP BY lang""",
    "sample_counts": _with(*BLOCKS)
    + f"""SELECT split, count(*) AS rows, least(count(*), {CAPS}) AS samples FROM blocks GROUP BY split""",
    "corpus_size": """WITH volumes AS (
        SELECT source, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY source),
      powers AS (
        SELECT *, CASE WHEN bytes >= 1073741824 THEN 3 WHEN bytes >= 1048576 THEN 2
                       WHEN bytes >= 1024 THEN 1 ELSE 0 END AS p FROM volumes),
      hundredths AS (
        SELECT *, round_even(bytes * 100.0::DOUBLE / (1024::DOUBLE ** p), 0)::BIGINT AS h FROM powers)
      SELECT source, bytes,
        CASE WHEN bytes = 0 THEN '0B'
             ELSE (h // 100) || '.' || CASE WHEN h % 10 = 0 THEN (h % 100 // 10)::VARCHAR
                                            ELSE lpad((h % 100)::VARCHAR, 2, '0') END
                  || ' ' || ['B', 'KB', 'MB', 'GB'][p + 1] END AS size
      FROM hundredths""",
    "split_summary": _with(*DOC_IDS)
    + "SELECT split, count(*) AS rows, sum(len(ids))::BIGINT AS tokens FROM ids GROUP BY split",
    "stream_tokenize": _with(*DOCS, ENCODED, ROWS) + DOC_TOKENS,
    "stream_render": _with(TURNS, _prompts(SYSTEM_BLOCK))
    + "SELECT conv_id, md5(text) AS text_md5, length(text)::BIGINT AS n FROM prompts",
    "stream_group_texts": _with(*STREAM)
    + BLOCK_ROWS.replace("batch_id,", "batch_id::BIGINT AS batch_id,"),
}
