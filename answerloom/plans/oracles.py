"""DuckDB SQL with the same result as each registered query, written independently of the Spark plans."""

from __future__ import annotations

from answerloom.conf import CHUNK_TEMPLATE, REWRITE_TEMPLATE, SYSTEM_TEMPLATE
from answerloom.functions.text import SPACE
from answerloom.plans.tables import CHUNK_WORDS, DIM, OVERLAP_WORDS

# The entities of the given pages, the ampersand last so that it cannot build new ones.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))

STRIDE = CHUNK_WORDS - OVERLAP_WORDS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, {lit(SPACE + '+')}), lambda w: w <> '')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, {lit(rf'\A{SPACE}+|{SPACE}+\z')}, '', 'g')"


def sentence(text: str) -> str:
    head = f"regexp_extract({text}, {lit(rf'(?s)\A(.*?\.)(?:{SPACE}|\z)')}, 1)"
    return strip(f"CASE WHEN {head} <> '' THEN {head} ELSE {text} END")


def markdown(html: str) -> str:
    """The tags that the given pages have, each by its own replacement; all others of them stand between blocks."""
    text = f"regexp_replace({html}, '(?s)<!--.*?-->|<head>.*?</head>|<script.*?</script>|<style.*?</style>', '', 'g')"
    for pattern, replacement in (
        ("[ \\t\\r\\n\\f]+", " "), ("</?b>|</li>", ""), ("<li>", "\n* "), ("<br>", "\n"), ("<h1>", "\n\n# "),
        ('<a href="([^"]*)">([^<]*)</a>', "[\\2](\\1)"), ("<[^>]*>", "\n\n"), (" *\n *", "\n"), (" {2,}", " "),
    ):
        text = f"regexp_replace({text}, {lit(pattern)}, {lit(replacement)}, 'g')"
    for entity, character in ENTITIES:
        text = f"replace({text}, {lit(entity)}, {lit(character)})"
    return f"regexp_replace({strip(text)}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def with_(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


DOCS = "docs AS (SELECT 'doc/' || doc_id AS path, text AS parsed_content FROM documents)"


def windows(source: str, name: str = "chunks") -> str:
    return f"""
    {name}_words AS (SELECT path, {words('parsed_content')} AS w FROM {source}),
    {name}_starts AS (
      SELECT path, w, unnest(range(0, greatest(0, ceil((len(w) - {CHUNK_WORDS}) / {STRIDE}.0))::BIGINT + 1)) AS i
      FROM {name}_words WHERE len(w) > 0),
    {name}_text AS (
      SELECT path, i AS chunk_pos, array_to_string(w[i * {STRIDE} + 1 : i * {STRIDE} + {CHUNK_WORDS}], ' ') AS chunked_text
      FROM {name}_starts),
    {name} AS (SELECT *, md5(chunked_text) AS chunk_id FROM {name}_text)"""


UNIQUE = """uniq AS (SELECT chunk_id, chunked_text, min(path) AS path, count(*) AS n_occurrences
    FROM chunks GROUP BY chunk_id, chunked_text)"""


def vectors(name: str, source: str, key: str, text: str) -> str:
    return f"""
    {name}_tok AS (SELECT {key} AS k, unnest({words(f'lower({text})')}) AS w FROM {source}),
    {name}_cnt AS (SELECT k, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM} AS b, count(*) AS c FROM {name}_tok GROUP BY ALL),
    {name}_nrm AS (SELECT k, sqrt(sum(c * c)) AS n FROM {name}_cnt GROUP BY k),
    {name} AS (SELECT k, b, (c / n)::FLOAT::DOUBLE AS v FROM {name}_cnt JOIN {name}_nrm USING (k))"""


def hits(q: str, x: str, k: int = 5) -> str:
    return f"""
    pairs AS (SELECT q.k AS qk, x.k AS chunk_id, round(sum(q.v * x.v), 6) AS score
      FROM {q} q JOIN {x} x USING (b) GROUP BY 1, 2),
    hits AS (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY score DESC, chunk_id) AS rank
      FROM pairs QUALIFY rank <= {k})"""


def template(text: str, **slots: str) -> str:
    """The same slots filled by plain concatenation."""
    pieces = [lit(text)]
    for name, column in slots.items():
        cut: list[str] = []
        for piece in pieces:
            if not piece.startswith("'"):
                cut.append(piece)
                continue
            before, *after = piece[1:-1].split("{" + name + "}")
            cut.append(f"'{before}'")
            for rest in after:
                cut += [f"coalesce({column}, '')", f"'{rest}'"]
        pieces = cut
    return "concat(" + ", ".join(p for p in pieces if p != "''") + ")"


RAW = """raw AS (SELECT url AS path, encode(html) AS good, page_id % 17 = 0 AS bad,
    html FROM pages)"""
TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

# --- request log and clicks

REQUESTS = """
    requests AS (
      SELECT 'r' || u.conv_id || '_' || u.turn AS request_id, u.text AS request, a.text AS response, u.conv_id, u.turn
      FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
      WHERE u.role = 'user' AND a.role = 'assistant'),
    trace AS (
      SELECT request_id, p AS position, 'doc/' || d.doc_id AS doc_uri, d.text AS content
      FROM (SELECT *, unnest(range(0, 5)) AS p FROM requests) r
      JOIN documents d ON d.doc_id = (r.conv_id * 7 + r.turn * 3 + r.p) % (SELECT max(doc_id) + 1 FROM documents))"""

CLICKS = """
    base AS (
      SELECT event_id, ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        'r' || (event_id % n) || '_' || ((event_id // n) % 4) AS request_id,
        CASE WHEN user_id % 20 <> 0 THEN 'u' || (user_id % 3) END AS reviewer
      FROM events, (SELECT max(conv_id) + 1 AS n FROM conversations)),
    text_clicks AS (
      SELECT event_id, request_id, reviewer, 's' || (k % 2) AS step_id, ts,
        CASE k % 3 WHEN 1 THEN '' WHEN 2 THEN 'edit ' || event_id END AS suggested_output,
        CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' ELSE 'unknown' END AS rating
      FROM base WHERE event_type IN ('purchase', 'error', 'signup')),
    chunk_clicks AS (
      SELECT event_id, request_id, reviewer, 's' || (k % 2) AS step_id, ts, k % 5 AS position,
        CASE event_type WHEN 'view' THEN 'true' ELSE 'false' END AS rating
      FROM base WHERE event_type NOT IN ('purchase', 'error', 'signup')),
    last_text AS (
      SELECT * FROM text_clicks
      QUALIFY row_number() OVER (PARTITION BY request_id, reviewer ORDER BY ts DESC, event_id DESC) = 1),
    last_chunk AS (
      SELECT * FROM chunk_clicks
      QUALIFY row_number() OVER (PARTITION BY request_id, reviewer, position, step_id ORDER BY ts DESC, event_id DESC) = 1),
    nested AS (
      SELECT request_id, reviewer, step_id, max(ts) AS ts,
        string_agg(position || ':' || rating, ',' ORDER BY position) AS votes
      FROM last_chunk GROUP BY request_id, reviewer, step_id),
    merged AS (
      SELECT coalesce(a.request_id, b.request_id) AS request_id, coalesce(a.step_id, b.step_id) AS step_id,
        b.step_id AS retrieval_step_id, coalesce(a.reviewer, b.reviewer) AS reviewer, coalesce(a.ts, b.ts) AS ts,
        a.rating, a.suggested_output, b.votes
      FROM last_text a FULL OUTER JOIN nested b
        ON a.request_id = b.request_id AND a.reviewer IS NOT DISTINCT FROM b.reviewer)"""

ATTACHED = """
    attached AS (
      SELECT r.request_id, r.request, r.response, m.rating AS is_correct, nullif(m.suggested_output, '') AS suggested_output,
        m.reviewer AS source_user, m.retrieval_step_id, m.votes
      FROM requests r LEFT JOIN merged m ON m.request_id = r.request_id),
    labelled AS (
      SELECT *,
        CASE is_correct WHEN 'positive' THEN coalesce(suggested_output, response)
                        WHEN 'negative' THEN suggested_output END AS expected_response,
        CASE is_correct WHEN 'positive' THEN 'thumbs_up' WHEN 'negative' THEN 'thumbs_down_edited'
                        ELSE 'no_feedback_provided' END AS source_tag,
        suggested_output IS NOT NULL AS has_edit
      FROM attached),
    relevant AS (
      SELECT c.request_id, c.reviewer AS source_user, c.step_id AS retrieval_step_id, t.position, t.doc_uri, t.content
      FROM last_chunk c JOIN trace t ON t.request_id = c.request_id AND t.position = c.position
      WHERE c.rating = 'true'),
    relevant_uris AS (
      SELECT request_id, source_user, retrieval_step_id, list(doc_uri ORDER BY position) AS uris
      FROM relevant GROUP BY ALL),
    evals AS (
      SELECT l.*, u.uris FROM labelled l LEFT JOIN relevant_uris u ON u.request_id = l.request_id
        AND u.source_user IS NOT DISTINCT FROM l.source_user
        AND u.retrieval_step_id IS NOT DISTINCT FROM l.retrieval_step_id)"""

# --- chat

SPLIT = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back,
      count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
    split AS (
      SELECT q.conv_id, q.text AS question, p.text AS previous_message, q.n - 1 AS n_history,
        CASE WHEN q.n > 1 THEN p.text || ' ' || q.text ELSE q.text END AS search_query
      FROM numbered q LEFT JOIN numbered p ON p.conv_id = q.conv_id AND p.back = 2 WHERE q.back = 1)"""

INDEX = (DOCS, windows("docs"), UNIQUE, vectors("xvec", "uniq", "chunk_id", "chunked_text"))

CONTEXTS = f"""
    contexts AS (
      SELECT qk, string_agg({template(CHUNK_TEMPLATE, chunk_text='u.chunked_text')}, '' ORDER BY rank) AS context,
        first(u.chunked_text ORDER BY rank) AS top_chunk, list(u.path ORDER BY rank) AS uris
      FROM hits JOIN uniq u USING (chunk_id) GROUP BY qk)"""

# --- evaluation

SCORES = f"""
    retrieval_answers AS (
      SELECT r.request_id, {sentence('c.top_chunk')} AS answer, c.uris FROM requests r LEFT JOIN contexts c ON c.qk = r.request_id),
    answers AS (
      SELECT request_id, 'retrieval' AS agent, answer, uris FROM retrieval_answers
      UNION ALL SELECT request_id, 'plain', {sentence('request')}, []::VARCHAR[] FROM requests),
    cases AS (
      SELECT e.request_id || '|' || coalesce(e.source_user, '-') || '|' || coalesce(e.retrieval_step_id, '-') AS eval_id,
        a.agent, a.answer, e.expected_response, list_distinct(e.uris) AS want, a.uris AS got_list,
        list_distinct(a.uris) AS got
      FROM evals e JOIN answers a USING (request_id)),
    tokens AS (
      SELECT eval_id, agent, token, sum(e) AS e, sum(g) AS g FROM (
        SELECT eval_id, agent, unnest({words('lower(expected_response)')}) AS token, 1 AS e, 0 AS g
        FROM cases WHERE expected_response IS NOT NULL
        UNION ALL
        SELECT eval_id, agent, unnest({words('lower(answer)')}), 0, 1 FROM cases WHERE expected_response IS NOT NULL)
      GROUP BY ALL),
    f1 AS (SELECT eval_id, agent, 2 * sum(least(e, g)) / (sum(e) + sum(g)) AS f FROM tokens GROUP BY ALL),
    scores AS (
      SELECT c.*, CASE WHEN want IS NOT NULL THEN len(list_intersect(want, got)) / len(want)::DOUBLE END AS doc_recall,
        CASE WHEN want IS NOT NULL AND len(got) > 0 THEN len(list_intersect(want, got)) / len(got)::DOUBLE END AS doc_precision,
        CASE WHEN want IS NOT NULL THEN coalesce(1.0 / list_min(list_filter(
          list_transform(want, lambda u: list_position(got_list, u)), lambda p: p > 0)), 0)::DOUBLE END AS reciprocal_rank,
        CASE WHEN expected_response IS NOT NULL
          THEN ({strip('answer')} = {strip('expected_response')})::INT::DOUBLE END AS exact_match,
        CASE WHEN expected_response IS NOT NULL THEN coalesce(f, 0)::DOUBLE END AS token_f1
      FROM cases c LEFT JOIN f1 USING (eval_id, agent))"""

METRICS = ("doc_recall", "doc_precision", "reciprocal_rank", "exact_match", "token_f1")
EVALS = (REQUESTS, CLICKS, ATTACHED)
SCORED = (
    *INDEX, *EVALS, vectors("qvec", "requests", "request_id", "request"), hits("qvec", "xvec"), CONTEXTS, SCORES,
)

# --- vectors of the embeddings table

DENSE = """
    dense AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    dense_pairs AS (SELECT q.vec_id AS query_id, x.vec_id, round(list_dot_product(q.v, x.v), 6) AS score FROM dense q, dense x),
    exact AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM dense_pairs QUALIFY rank <= 5)"""


def cell_search(planes: int = 8, probes: int = 64) -> str:
    """Sign cells of Hadamard rows, the cheapest cells per query, then exact scores inside of them."""
    return f"""
    flat AS (SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS i, len(v) AS d FROM dense),
    gaps AS (
      SELECT vec_id, p, round(sum(x * (1 - 2 * (bit_count((p + 1) & i) % 2))) / sqrt(max(d)), 9) AS gap
      FROM flat, range(0, {planes}) t(p) GROUP BY vec_id, p),
    homes AS (SELECT vec_id, sum((gap >= 0)::INT << p)::BIGINT AS cell FROM gaps GROUP BY vec_id),
    costs AS (
      SELECT vec_id, c, round(sum(CASE WHEN ((c >> p) & 1) <> (gap >= 0)::INT THEN gap * gap ELSE 0 END), 9) AS cost
      FROM gaps, range(0, {1 << planes}) t(c) GROUP BY vec_id, c),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cost, c) AS n FROM costs),
    bounds AS (SELECT vec_id, sqrt(greatest(list_dot_product(v, v) - cost, 0)) AS open_bound
      FROM ordered JOIN dense USING (vec_id) WHERE n = {probes + 1}),
    near AS (
      SELECT o.vec_id AS query_id, h.vec_id, p.score,
        row_number() OVER (PARTITION BY o.vec_id ORDER BY p.score DESC, h.vec_id) AS rank
      FROM ordered o JOIN homes h ON h.cell = o.c
      JOIN dense_pairs p ON p.query_id = o.vec_id AND p.vec_id = h.vec_id
      WHERE o.n <= {probes} QUALIFY rank <= 5),
    settled AS (SELECT n.query_id, count(*) = 5 AND min(n.score) > min(b.open_bound) + 1e-6 AS proven
      FROM near n JOIN bounds b ON b.vec_id = n.query_id GROUP BY 1)"""


PAGE_DOCS = f"page_docs AS (SELECT url AS path, {markdown('html')} AS parsed_content FROM pages WHERE page_id % 17 <> 0)"

# --- links

HOST = r"lower(regexp_replace(regexp_extract({}, '\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '\A.*@|:[0-9]*\z', '', 'g'))"
URL_PATH = r"regexp_extract(url, '\A[a-z]+://[^/?#]*([^?#]*)', 1)"
# Links in the data are root-relative or fragments; the other kinds are covered by unit tests.
TARGET = r"""CASE WHEN regexp_matches(href, '\A[A-Za-z][A-Za-z0-9+.\-]*:') THEN href
      WHEN starts_with(href, '//') THEN regexp_extract(url, '\A([a-z]+:)', 1) || href
      WHEN starts_with(href, '/') THEN regexp_extract(url, '\A([a-z]+://[^/?#]*)', 1) || href
      WHEN starts_with(href, '#') THEN regexp_extract(url, '\A([^#]*)', 1) || href END"""

# The splitter: texts and their long pieces are cut level by level; runs of short pieces are merged by prefix sums, and
# the front of the next chunk moves to the smallest start that fits.
SEPARATED = "[chr(10) || chr(10), chr(10), ' ', '']"
SIZE, OVERLAP = 400, 100
CHUNK_RECURSIVE = f"""
WITH RECURSIVE {DOCS},
nodes(path, ord, txt, lvl) AS (
  SELECT path, [0::BIGINT], coalesce(parsed_content, ''), 1 FROM docs
  UNION ALL
  SELECT path, list_append(ord, i), pieces[i], used + 1
  FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM (
    SELECT *, list_filter(CASE WHEN used = 4 THEN string_split(txt, '') ELSE
        list_transform(string_split(txt, {SEPARATED}[used]), lambda t, k: CASE WHEN k = 1 THEN t ELSE {SEPARATED}[used] || t END)
      END, lambda t: t <> '') AS pieces FROM (
      SELECT *, CASE WHEN lvl <= 1 AND contains(txt, chr(10) || chr(10)) THEN 1 WHEN lvl <= 2 AND contains(txt, chr(10)) THEN 2
        WHEN lvl <= 3 AND contains(txt, ' ') THEN 3 ELSE 4 END AS used FROM nodes)))
  WHERE length(pieces[i]) >= {SIZE} AND used < 4),
cut AS (
  SELECT path, ord, unnest(range(1, len(pieces) + 1)) AS i, unnest(pieces) AS piece FROM (
    SELECT *, list_filter(CASE WHEN used = 4 THEN string_split(txt, '') ELSE
        list_transform(string_split(txt, {SEPARATED}[used]), lambda t, k: CASE WHEN k = 1 THEN t ELSE {SEPARATED}[used] || t END)
      END, lambda t: t <> '') AS pieces FROM (
      SELECT *, CASE WHEN lvl <= 1 AND contains(txt, chr(10) || chr(10)) THEN 1 WHEN lvl <= 2 AND contains(txt, chr(10)) THEN 2
        WHEN lvl <= 3 AND contains(txt, ' ') THEN 3 ELSE 4 END AS used FROM nodes))),
runs AS (
  SELECT *, count(*) FILTER (length(piece) >= {SIZE}) OVER (PARTITION BY path, ord ORDER BY i) AS run FROM cut),
segments AS MATERIALIZED (
  SELECT path, list_append(ord, min(i)) AS seg, count(*) AS n, list(piece ORDER BY i) AS pieces,
    list_prepend(0::HUGEINT, list(total ORDER BY i)) AS p
  FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY path, ord, run ORDER BY i) AS total FROM runs WHERE length(piece) < {SIZE})
  GROUP BY path, ord, run),
walk(path, seg, front, stop, done) AS (
  SELECT path, seg, 0::BIGINT, coalesce(e, n), e IS NULL
  FROM (SELECT *, list_filter(range(1, n), lambda i: p[i + 2] - p[1] > {SIZE})[1] AS e FROM segments)
  UNION ALL
  SELECT path, seg, f, coalesce(e, n), e IS NULL
  FROM (SELECT *, list_filter(range(stop + 1, n), lambda i: p[i + 2] - p[f + 1] > {SIZE})[1] AS e FROM (
    SELECT s.*, w.stop, list_filter(range(w.front, w.stop + 1), lambda f: p[w.stop + 1] - p[f + 1] <= {OVERLAP}
        AND (p[w.stop + 2] - p[f + 1] <= {SIZE} OR p[w.stop + 1] - p[f + 1] = 0))[1] AS f
    FROM walk w JOIN segments s USING (path, seg) WHERE NOT w.done))),
texts AS (
  SELECT path, seg, front, {strip("array_to_string(pieces[front + 1 : stop], '')")} AS chunked_text
  FROM walk JOIN segments USING (path, seg))
SELECT path, row_number() OVER (PARTITION BY path ORDER BY seg, front) - 1 AS chunk_pos, chunked_text,
  md5(chunked_text) AS chunk_id
FROM texts WHERE chunked_text <> ''
"""


ANCHORS = """SELECT url, replace(unnest(regexp_extract_all(
    regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g'), '<a href="([^"]*)"', 1)), '&amp;', '&') AS href FROM pages"""
SYNTHETIC_FAILURES = """
    SELECT CASE WHEN contains(text, '%%') THEN 'ERROR: refused' ELSE 'SUCCESS' END AS status, count(*) AS n
    FROM documents GROUP BY 1"""
CHAT_FAILURES = f"""
    SELECT c.conv_id, c.turn, 9007199254740992 + c.conv_id AS big,
      CASE WHEN p.turn IS NOT NULL AND length({template(
          REWRITE_TEMPLATE, chat_history="p.role || ': ' || p.text", question='c.text')}) % 3 = 0 THEN 'ERROR: no rewrite'
        WHEN length(c.text) % 5 = 0 THEN 'ERROR: no answer' ELSE 'SUCCESS' END AS status,
      CASE WHEN status = 'SUCCESS' THEN 'answer ' || length(c.text) END AS answer
    FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1"""
EMBED_REJECTS = """
    SELECT 'doc/' || min(doc_id) AS path, md5(text) AS chunk_id, 'ERROR: too long' AS status
    FROM documents WHERE length(text) > 2000 GROUP BY text"""
STREAM_REJECTS = """
    SELECT 'parse' AS stage, url AS path, 'ERROR: content is not valid utf-8' AS status FROM pages WHERE page_id % 17 = 0"""

ORACLES: dict[str, str] = {
    "raw_page_inventory": with_(RAW, select="""
        SELECT path, (octet_length(good) + bad::INT)::BIGINT AS length,
          CASE WHEN bad THEN md5(good || '\\xFF'::BLOB) ELSE md5(good) END AS content_md5, NOT bad AS is_text FROM raw"""),
    "parse_html_native": f"""
        SELECT url AS path, length({markdown('html')})::VARCHAR AS num_pages, {markdown('html')} AS parsed_content FROM pages""",
    "parse_status_split": """
        SELECT url AS path, CASE WHEN page_id % 17 = 0 THEN 'ERROR: content is not valid utf-8' ELSE 'SUCCESS' END AS status
        FROM pages""",
    "parse_report": with_(PAGE_DOCS, windows("page_docs"), select="""
        SELECT 'parsed' AS stage, 'SUCCESS' AS status, count(*) AS n_rows FROM page_docs
        UNION ALL SELECT 'rejected', 'ERROR: content is not valid utf-8', count(*) FROM pages WHERE page_id % 17 = 0
        UNION ALL SELECT 'chunks', 'SUCCESS', count(*) FROM chunks"""),
    "assemble_pages": with_(DOCS, select="""
        SELECT path, len(string_split(parsed_content, chr(10)))::BIGINT AS num_pages, parsed_content FROM docs"""),
    "newline_squeeze": with_(DOCS, f"""
        t AS (SELECT path, regexp_replace({strip('parsed_content')}, '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM docs)""",
        select="SELECT path, text, length(text) AS n_chars FROM t"),
    "doc_projection": with_(DOCS, select="""
        SELECT path AS doc_uri, parsed_content AS content, length(parsed_content)::VARCHAR AS num_pages FROM docs"""),
    "chunk_word_window": with_(DOCS, windows("docs"), select="SELECT path, chunk_pos, chunked_text FROM chunks"),
    "chunk_line_pack": with_(DOCS, """
        lines AS (SELECT path, unnest(string_split(parsed_content, chr(10))) AS line,
          unnest(range(0, len(string_split(parsed_content, chr(10))))) AS i FROM docs)""", """
        sized AS (SELECT path, i, line, length(line) AS n FROM lines)""", """
        walk AS (
          SELECT path, i, n AS used, 0::BIGINT AS part FROM sized WHERE i = 0
          UNION ALL
          SELECT s.path, s.i, CASE WHEN w.used + 1 + s.n <= 400 THEN w.used + 1 + s.n ELSE s.n END,
            CASE WHEN w.used + 1 + s.n <= 400 THEN w.part ELSE w.part + 1 END
          FROM walk w JOIN sized s ON s.path = w.path AND s.i = w.i + 1)""", f"""
        packed AS (SELECT path, part, string_agg(line, chr(10) ORDER BY i) AS chunked_text
          FROM walk JOIN sized USING (path, i) GROUP BY path, part),
        shown AS (SELECT * FROM packed WHERE {strip('chunked_text')} <> '')""", select="""
        SELECT path, row_number() OVER (PARTITION BY path ORDER BY part) - 1 AS chunk_pos, chunked_text FROM shown"""),
    "chunk_ids": with_(DOCS, windows("docs"), select="SELECT path, chunk_pos, chunk_id FROM chunks"),
    "chunk_primary_key": with_(DOCS, windows("docs"), UNIQUE, select="SELECT * FROM uniq"),
    "chunk_sources": with_(DOCS, windows("docs"), select="SELECT DISTINCT chunk_id, path FROM chunks"),
    "snapshot_diff": """
        SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'insert' WHEN 1 THEN 'delete' ELSE 'update' END AS op,
          md5(CASE WHEN doc_id % 10 = 2 THEN text || ' v2' ELSE text END) AS text_md5
        FROM documents WHERE doc_id % 10 IN (0, 1, 2)""",
    "index_upsert": """
        SELECT doc_id, md5(CASE WHEN doc_id % 10 = 2 THEN text || ' v2' ELSE text END) AS text_md5
        FROM documents WHERE doc_id % 10 <> 1""",
    "index_sync": with_("""
        docs AS (SELECT 'doc/' || doc_id AS path, CASE WHEN doc_id % 10 = 2 THEN text || ' v2' ELSE text END AS parsed_content
          FROM documents WHERE doc_id % 10 <> 1)""", windows("docs"), UNIQUE,
        select=f"SELECT chunk_id, path, {DIM}::BIGINT AS dim FROM uniq"),
    "index_generations": with_("""
        docs AS (SELECT 'doc/' || doc_id AS path, CASE WHEN doc_id % 10 = 2 THEN text || ' v2' ELSE text END AS parsed_content
          FROM documents WHERE doc_id % 10 <> 1)""", windows("docs"), UNIQUE, vectors("vec", "uniq", "chunk_id", "chunked_text"),
        """sums AS (SELECT k, sum(round(v * 1000000)::BIGINT * (b + 1))::BIGINT AS vector_sum FROM vec GROUP BY k)""",
        select="""SELECT chunk_id, path, md5(chunked_text) AS text_md5, vector_sum FROM uniq JOIN sums ON k = chunk_id"""),
    "hashed_embedding": with_(vectors("vec", "benchmark", "item_id", "text"), select="""
        SELECT k AS item_id, b AS bucket, round(v, 6) AS weight FROM vec"""),
    "knn_exact": with_(DENSE, select="SELECT query_id, vec_id, score, rank FROM exact"),
    "knn_exact_blocks": with_(DENSE, select="SELECT query_id, vec_id, score, rank FROM exact"),
    "knn_learned_cells": with_(DENSE, select="SELECT query_id, vec_id, score, rank FROM exact"),
    "knn_query_blocks": with_(DENSE, select="SELECT query_id, vec_id, score, rank FROM exact"),
    "knn_cell_report": """
        SELECT vec_id AS query_id, true AS proven, (SELECT count(*) FROM embeddings) AS n_rows, true AS spared FROM embeddings""",
    "knn_certified": with_(DENSE, select="SELECT query_id, vec_id, score, rank FROM exact"),
    "knn_cells": with_(DENSE, cell_search(), select="""
        SELECT query_id, vec_id, score, rank, proven FROM near JOIN settled USING (query_id)"""),
    "knn_recall": with_(DENSE, cell_search(), select="""
        SELECT count(DISTINCT e.query_id) AS n_queries, round(count(n.vec_id) / count(*)::DOUBLE, 6) AS recall
        FROM exact e LEFT JOIN near n ON n.query_id = e.query_id AND n.vec_id = e.vec_id"""),
    "similarity_search": with_(*INDEX, vectors("qvec", "benchmark", "item_id", "text"), hits("qvec", "xvec"), select="""
        SELECT qk AS item_id, rank, score, chunk_id AS primary_key, path AS document_uri
        FROM hits JOIN uniq USING (chunk_id)"""),
    "similarity_search_ann": with_(*INDEX, vectors("qvec", "benchmark", "item_id", "text"), hits("qvec", "xvec"), select="""
        SELECT qk AS item_id, rank, score, chunk_id AS primary_key, path AS document_uri
        FROM hits JOIN uniq USING (chunk_id)"""),
    "similarity_search_cells": with_(*INDEX, vectors("qvec", "benchmark", "item_id", "text"), hits("qvec", "xvec"), select="""
        SELECT qk AS item_id, rank, score, chunk_id AS primary_key, path AS document_uri, md5(chunked_text) AS text_md5
        FROM hits JOIN uniq USING (chunk_id)"""),
    "context_format": with_(*INDEX, vectors("qvec", "benchmark", "item_id", "text"), hits("qvec", "xvec"), CONTEXTS,
                            select="SELECT qk AS item_id, context FROM contexts"),
    "chat_question": with_(SPLIT, select="SELECT conv_id, question, n_history FROM split"),
    "chat_history": with_(SPLIT, select="SELECT conv_id, turn, role, text FROM numbered WHERE back > 1"),
    "chat_rewrite_branch": with_(SPLIT, select="SELECT conv_id, n_history > 0 AS rewritten, search_query FROM split"),
    "chat_rewrite_prompt": with_(SPLIT, f"""
        sizes AS (SELECT conv_id, 2 + count(*) FILTER (back > 1 AND role IN ('user', 'assistant')) AS n_prompt_messages
          FROM numbered GROUP BY conv_id),
        prompts AS (
          SELECT conv_id, -1::BIGINT AS position, {lit(REWRITE_TEMPLATE[:REWRITE_TEMPLATE.index('{chat_history}')])} AS content
          FROM split WHERE n_history > 0
          UNION ALL
          SELECT conv_id, turn, CASE WHEN n = 1 THEN NULL WHEN back = 1
            THEN {template(REWRITE_TEMPLATE[REWRITE_TEMPLATE.index('{chat_history}') + 14:], question='text')}
            ELSE CASE WHEN back < n THEN chr(10) ELSE '' END || role || ': ' || text END
          FROM numbered)""", select="""
        SELECT conv_id, position, content, n_prompt_messages FROM prompts JOIN sizes USING (conv_id)"""),
    "chat_rewrite_turns": f"""
        SELECT c.conv_id, c.turn,
          CASE WHEN p.turn IS NOT NULL
            THEN {template(REWRITE_TEMPLATE, chat_history="p.role || ': ' || p.text", question='c.text')} END AS rewrite_prompt,
          2::BIGINT + coalesce(p.role IN ('user', 'assistant'), false)::BIGINT AS n_prompt_messages
        FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""",
    "chat_prompt": with_(SPLIT, select=f"""
        SELECT conv_id, -1::BIGINT AS position, 'system' AS role,
          {template(SYSTEM_TEMPLATE, context='max(CASE WHEN turn = 1 THEN text END)')} AS content
        FROM conversations GROUP BY conv_id
        UNION ALL
        SELECT conv_id, turn, CASE WHEN back = 1 THEN 'user' ELSE role END, text
        FROM numbered WHERE back = 1 OR role IN ('user', 'assistant')"""),
    "rag_batch": with_(*INDEX, SPLIT, vectors("qvec", "split", "conv_id", "search_query"), hits("qvec", "xvec"), CONTEXTS,
                       select=f"""
        SELECT conv_id, question, search_query, context, {sentence('top_chunk')} AS answer
        FROM split LEFT JOIN contexts ON qk = conv_id"""),
    "rag_turns_models": with_(*INDEX, SPLIT, """
        models AS (SELECT conv_id, question, CASE WHEN n_history > 0 THEN r || ' ' || r ELSE question END AS search_query
          FROM (SELECT *, string_split('Question: ' || question, chr(10))[-1] AS r FROM split))""",
        vectors("qvec", "models", "conv_id", "search_query"), hits("qvec", "xvec"), CONTEXTS, f"""
        prompts AS (SELECT conv_id, 2 + count(*) FILTER (back > 1 AND role IN ('user', 'assistant')) AS n FROM numbered GROUP BY conv_id),
        systems AS (SELECT m.*, p.n, context, length({template(SYSTEM_TEMPLATE, context='context')}) AS chars
          FROM models m JOIN prompts p USING (conv_id) LEFT JOIN contexts ON qk = conv_id)""", select="""
        SELECT conv_id, search_query, context,
          CASE WHEN n < 7 THEN n || ' messages, ' || chars || ' characters, asked: ' || question END AS answer,
          CASE WHEN n < 7 THEN 'SUCCESS' ELSE 'ERROR: too many messages' END AS answer_status FROM systems"""),
    "feedback_latest_text": with_(CLICKS, select=f"""
        SELECT request_id, reviewer, step_id, {TS.format('ts')} AS ts, suggested_output, rating, event_id FROM last_text"""),
    "feedback_latest_retrieval": with_(CLICKS, select=f"""
        SELECT request_id, reviewer, position, step_id, {TS.format('ts')} AS ts, rating, event_id FROM last_chunk"""),
    "feedback_nested": with_(CLICKS, select=f"""
        SELECT request_id, reviewer, step_id, {TS.format('ts')} AS ts, votes FROM nested"""),
    "feedback_merged": with_(CLICKS, select=f"""
        SELECT request_id, step_id, retrieval_step_id, reviewer, {TS.format('ts')} AS ts, rating, suggested_output, votes
        FROM merged"""),
    "ground_truth_attach": with_(*EVALS, select="""
        SELECT request_id, is_correct, suggested_output, source_user, retrieval_step_id, votes FROM attached"""),
    "eval_labels": with_(*EVALS, select="""
        SELECT request_id, source_user, retrieval_step_id, expected_response, source_tag, has_edit FROM labelled"""),
    "trace_layouts": with_(REQUESTS, """
        listed AS (SELECT request_id, length(request) % 4 AS kind,
          string_agg(doc_uri || ' ' || md5(content), ',' ORDER BY position) AS chunks FROM trace JOIN requests USING (request_id)
          GROUP BY ALL)""", select="""
        SELECT request_id, CASE kind WHEN 0 THEN chunks END AS plain_chunks, CASE kind WHEN 1 THEN chunks END AS other_chunks,
          ['SUCCESS', 'ERROR: trace has no list of chunks', 'ERROR: trace is no JSON', 'no trace'][kind + 1] AS plain_status,
          ['ERROR: trace has no list of chunks', 'SUCCESS', 'ERROR: trace is no JSON', 'no trace'][kind + 1] AS other_status
        FROM listed"""),
    "expected_context": with_(*EVALS, select="""
        SELECT request_id, source_user, retrieval_step_id, doc_uri, md5(content) AS content_md5 FROM relevant"""),
    "eval_set": with_(*EVALS, select="""
        SELECT request, request_id, expected_response, array_to_string(uris, ',') AS expected_uris, source_user, source_tag
        FROM evals"""),
    "eval_questions_only": with_(REQUESTS, select="""
        SELECT request, request_id, NULL::VARCHAR AS expected_response, NULL::VARCHAR AS source_user,
          'no_feedback_provided' AS source_tag FROM requests"""),
    "synthetic_quota": with_(DOCS, select="""
        SELECT path AS doc_uri, 1540 // n + (rn <= 1540 % n)::BIGINT AS quota
        FROM (SELECT path, row_number() OVER (ORDER BY md5(path), path) AS rn, count(*) OVER () AS n FROM docs)"""),
    "synthetic_evals": with_(DOCS, f"""
        ranked AS (SELECT path, parsed_content, row_number() OVER (ORDER BY md5(path), path) AS rn, count(*) OVER () AS n
          FROM docs),
        cut AS (SELECT path, 1540 // n + (rn <= 1540 % n)::BIGINT AS quota,
          list_filter(list_transform(string_split(regexp_replace(parsed_content, '\\.[ \\n]+', '.' || chr(10), 'g'), chr(10)),
            lambda s: {strip('s')}), lambda s: s <> '') AS s FROM ranked),
        picked AS (SELECT path, s, unnest(range(0, quota)) AS eval_no FROM cut),
        chosen AS (SELECT path, eval_no, coalesce(s[eval_no % greatest(len(s), 1) + 1], '') AS sentence FROM picked)""",
        select="""
        SELECT md5(path || '#' || eval_no) AS request_id, path AS doc_uri, eval_no,
          'What do the documents say about: ' || sentence || '?' AS request, sentence AS expected_response FROM chosen"""),
    "eval_rows": with_(*SCORED, select="SELECT eval_id, agent, " + ", ".join(
        f"round({m}, 6) AS {m}" for m in METRICS) + " FROM scores"),
    "eval_judged": with_(*SCORED, f"""
        judged AS (SELECT eval_id, agent, list_distinct({words('lower(expected_response)')}) AS want,
          list_distinct({words("lower(coalesce(answer, ''))")}) AS given FROM scores WHERE expected_response IS NOT NULL),
        shares AS (SELECT *, len(list_intersect(want, given)) AS found FROM judged)""", select="""
        SELECT eval_id, agent, round(CASE WHEN len(want) > 0 THEN found / len(want)::DOUBLE ELSE 0 END, 6) AS judge_score,
          found || ' of ' || len(want) || ' expected words found' AS judge_rationale FROM shares"""),
    "eval_summary": with_(*SCORED, select="""
        SELECT agent, count(*) AS n_questions, count(expected_response) AS n_expected_response,
          count(doc_recall) AS n_expected_context, """ + ", ".join(
        f"round(avg({m}), 6) AS mean_{m}" for m in METRICS) + " FROM scores GROUP BY agent"),
    "agent_compare": with_(*SCORED, select="SELECT a.eval_id, " + ", ".join(
        f"round(a.{m} - b.{m}, 6) AS delta_{m}" for m in METRICS) + """
        FROM scores a JOIN scores b ON a.eval_id = b.eval_id AND a.agent = 'retrieval' AND b.agent = 'plain'"""),
    "link_edges": f"""
        SELECT url AS src, href, {TARGET} AS dst, {HOST.format('url')} = {HOST.format(f'({TARGET})')} AS same_site
        FROM ({ANCHORS}) WHERE href <> ''""",
    "chunk_recursive": CHUNK_RECURSIVE,
    "crawl_pages": f"""
        WITH links AS (SELECT url AS src, {TARGET} AS dst, {HOST.format('url')} = {HOST.format(f'({TARGET})')} AS same_site
          FROM ({ANCHORS}) WHERE href <> ''),
        stored AS (SELECT DISTINCT url FROM pages)
        SELECT url, 0::BIGINT AS round, 'SUCCESS' AS status FROM stored
        UNION
        SELECT split_part(dst, '#', 1), 1::BIGINT, 'ERROR: page not found' FROM links
        WHERE same_site AND split_part(dst, '#', 1) NOT IN (SELECT url FROM stored)""",
    "synthetic_failures": SYNTHETIC_FAILURES,
    "chat_plug_failures": CHAT_FAILURES,
    "embed_rejects": EMBED_REJECTS,
    "stream_rejects": STREAM_REJECTS,
    "page_filename_collisions": f"""
        SELECT file_name, count(DISTINCT url) AS n_urls, min(url) AS first_url
        FROM (SELECT url, replace(trim({URL_PATH}, '/'), '/', '_') || '.html' AS file_name FROM pages)
        GROUP BY file_name HAVING count(DISTINCT url) > 1""",
    "page_files_saved": f"""
        WITH named AS (SELECT url, html, regexp_replace(replace(trim({URL_PATH}, '/'), '/', '_') || '.html', '\\A([._])', 'home\\1')
          AS file_name FROM pages)
        SELECT file_name, strlen(arg_min(html, url))::BIGINT AS length, md5(arg_min(html, url)) AS content_md5
        FROM named GROUP BY file_name""",
    "crawl_closure": with_("""
        edges AS (SELECT page_id AS src, (page_id * 7 + j * 13 + 1) % (SELECT max(page_id) + 1 FROM pages) AS dst
          FROM pages, range(0, 2) t(j) WHERE page_id % 5 <> 0)""", """
        walk AS (
          SELECT 1::BIGINT AS page_id, 0::BIGINT AS round
          UNION
          SELECT e.dst, w.round + 1 FROM walk w JOIN edges e ON e.src = w.page_id
          WHERE w.round < (SELECT count(*) FROM pages) AND w.round < 64)""",
        select="SELECT page_id, min(round) AS round FROM walk GROUP BY page_id"),
    "stream_index_compacted": with_(PAGE_DOCS, windows("page_docs"), UNIQUE, vectors("vec", "uniq", "chunk_id", "chunked_text"), """
        sums AS (SELECT k, sum(round(v * 1000000)::BIGINT * (b + 1))::BIGINT AS vector_sum FROM vec GROUP BY k)""",
        select="SELECT chunk_id, path, md5(chunked_text) AS text_md5, vector_sum FROM uniq JOIN sums ON k = chunk_id"),
    "stream_index_sync": with_(PAGE_DOCS, windows("page_docs"), UNIQUE,
                               select="SELECT chunk_id, path, chunked_text FROM uniq"),
    "stream_feedback": with_(CLICKS, select=f"""
        SELECT request_id, step_id, retrieval_step_id, reviewer, {TS.format('ts')} AS ts, rating, suggested_output, votes
        FROM merged"""),
    "stream_feedback_state": with_(CLICKS, select=f"""
        SELECT request_id, step_id, retrieval_step_id, reviewer, {TS.format('ts')} AS ts, rating, suggested_output, votes
        FROM merged"""),
}
