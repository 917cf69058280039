"""The registered query of each operator, and its SQL where SQL can express it."""

from .chat import op8_chat_format
from .mixing import op9_source_mixing
from .ngram_join import op5_ngram_jaccard
from .packing import op7_lexical_packing
from .quality import op1_bradley_terry_quality
from .simhash import op6_simhash
from .substring import op10_super_kmer_dedup
from .token_files import op2_token_files
from .warc import op4_content_addressed_warc
from .weak_rules import op3_weak_rules

QUERIES = {f.__name__: f for f in (op1_bradley_terry_quality, op2_token_files, op3_weak_rules, op4_content_addressed_warc, op5_ngram_jaccard, op6_simhash, op7_lexical_packing, op8_chat_format, op9_source_mixing, op10_super_kmer_dedup)}
#: Each operator's rows by plain comparison, where SQL can say them.
ORACLES: dict[str, str] = {
    "op4_content_addressed_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM f""",
    "op5_ngram_jaccard": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 4) x
            UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id, doc_id AS t FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.t = e.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(t) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id""",
    "op8_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
        ),
        g AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
                sum(length('<|im_start|>') + length(role) + 1 + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + length('<|im_end|>') + 1) AS formatted_chars
            FROM t GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g""",
    "op10_super_kmer_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        k AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20) x),
        m AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM k),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM m WHERE r > 1),
        a AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
        kept AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS text, count(*) AS n FROM a LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.p = a.p WHERE g.p IS NULL GROUP BY a.doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""",
}
