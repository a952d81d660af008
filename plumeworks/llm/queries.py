"""The registered queries of this folder and, where it can state them, their SQL."""

from pyspark.sql import functions as F

from plumeworks.llm import cover_tree, hamming, language, lines, lm, manifest, minhash, mixing, packing, pages, resample, secret_scan, token_files
from plumeworks.llm.common import table
from plumeworks.session import work_folder


def op1_token_files(spark, sf_dir):
    folder = work_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.digest(token_files.read_token_files(spark, folder))


def op2_cube_mix(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op3_dart_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_page_text(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_secret_ledger(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op6_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op7_hamming_top_k(spark, sf_dir):
    return hamming.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_cover_tree_dedup(spark, sf_dir):
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def _line_digest(docs):
    n = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"), n.alias("n_lines"), "lines_removed")


def op10_line_dedup(spark, sf_dir):
    """Every line that is not blank takes part; one edit makes those of 16 characters or more equal."""
    return _line_digest(lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_bit_sliced_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_context_mixing(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    """The manifest of the documents; in every second one, by the crc32 of its id, the line breaks of the text are tampered with."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": changed})


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_cube_mix, op3_dart_minhash, op4_page_text, op5_secret_ledger, op6_language_id, op7_hamming_top_k,
    op8_best_fit_packing, op9_cover_tree_dedup, op10_line_dedup,
    op11_bit_sliced_resample, op12_context_mixing, op13_merkle_manifest,
)}


def _spans(place: int, pattern: str, group: int, least: int) -> str:
    """SQL list of the spans of a rule in ``x``: a match starts after the gaps and matches before it."""
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""(SELECT list({{'s': CAST(s AS BIGINT), 'k': {place}, 'e': CAST(s + length(hit) AS BIGINT)}}) FILTER (WHERE length(part) >= {least}) FROM (
        SELECT hit, part, sum(length(gap)) OVER (ORDER BY i) + sum(length(hit)) OVER (ORDER BY i) - length(hit) AS s FROM (
            SELECT unnest(regexp_extract_all(x, {p}, 0)) AS hit, unnest(regexp_extract_all(x, {p}, {group})) AS part,
                unnest(regexp_split_to_array(x, {p})[:len(regexp_extract_all(x, {p}, 0))]) AS gap, unnest(range(len(regexp_extract_all(x, {p}, 0)))) AS i)))"""


_BLANK = "' ' || chr(9) || chr(13) || chr(12) || chr(11)"
_LINE_DEDUP = f"""
        WITH parts AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents WHERE doc_id IS NOT NULL
        ), rows AS (
            SELECT doc_id, pos, raw, trim(raw, {_BLANK}) AS line FROM parts
        ), firsts AS (
            SELECT line, length(line) AS n, min((doc_id, pos)) AS first FROM rows WHERE length(line) >= 1 GROUP BY line
        ), halves AS (
            SELECT line, n, first, unnest([(0, n, left(line, n // 2)), (1, n, right(line, n // 2)), (0, n - 1, left(line, (n - 1) // 2)), (1, n - 1, right(line, (n - 1) // 2))]) AS half
            FROM firsts WHERE n >= 16
        ), pairs AS (
            SELECT DISTINCT a.line AS late, b.line AS early, a.n AS n, b.n AS m FROM halves a JOIN halves b ON a.half = b.half AND b.first < a.first AND abs(a.n - b.n) <= 1
        ), parted AS (
            SELECT *, coalesce(list_position(list_transform(list_zip(string_split(late, ''), string_split(early, '')), lambda z: coalesce(z[1] <> z[2], true)), true), 1 + greatest(n, m)) AS i FROM pairs
        ), near AS (
            SELECT DISTINCT late FROM parted WHERE substr(late, i + CASE WHEN n >= m THEN 1 ELSE 0 END) = substr(early, i + CASE WHEN m >= n THEN 1 ELSE 0 END)
        ), marked AS (
            SELECT r.doc_id, r.pos, r.raw, f.line IS NOT NULL AND (e.late IS NOT NULL OR f.first <> (r.doc_id, r.pos)) AS gone
            FROM rows r LEFT JOIN firsts f ON r.line = f.line LEFT JOIN near e ON r.line = e.late
        ), kept AS (
            SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) FILTER (WHERE gone) AS n FROM marked GROUP BY doc_id
        ), cut AS (
            SELECT d.doc_id, coalesce(k.text, d.text) AS text, coalesce(k.n, 0) AS n FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
        )
        SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(n AS BIGINT) AS lines_removed
        FROM cut"""


#: SQL table ``tab``: the 256 entries of the crc32 table, from its polynomial.
_CRC_TABLE = """tab AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text, next to ``tab``."""
    data = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || hex(encode({text}))[2 * k + 1 : 2 * k + 2] AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256(concat({', '.join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values)}))"


_NAMES = "[" + ", ".join(f"'{kind}'" for kind in secret_scan.RULES) + "]"
_LISTED = f"coalesce(array_to_string(list_transform({{}}, lambda v: {_NAMES}[v.k + 1] || ':' || v.s || ':' || v.e), ','), '')"
_PLACES = {kind: k for k, kind in enumerate(secret_scan.RULES)}
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
ORACLE: dict[str, str] = {
    "op7_hamming_top_k": f"""
        WITH bits AS (
            SELECT vec_id AS id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings WHERE {_FINITE}
        ), codes AS (
            SELECT id, list(CAST(x > 0 AS INTEGER) ORDER BY i) AS code FROM bits GROUP BY id
        ), pairs AS (
            SELECT q.id AS query_id, r.id, CAST(len(list_filter(list_zip(q.code, r.code), lambda z: coalesce(z[1], 0) <> coalesce(z[2], 0))) AS INTEGER) AS distance
            FROM codes q JOIN codes r ON q.id % 20 = 0 AND q.id <> r.id
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank, id, distance FROM pairs
        )
        SELECT query_id, rank, id, distance FROM ranked WHERE rank <= {hamming.K}""",
    "op5_secret_ledger": f"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS x FROM documents
        ), found AS (
            SELECT doc_id, list_sort(flatten([{", ".join(f"coalesce({_spans(k, r[1], r[2], r[3])}, [])" for k, r in enumerate(secret_scan.RULES.values()))}])) AS spans FROM texts
        )
        SELECT doc_id, {", ".join(f"CAST(len(list_filter(spans, lambda v: v.k = {_PLACES[kind]})) AS BIGINT) AS n_{kind}" for kind in secret_scan.BASE)},
            sha256({_LISTED.format(f"list_filter(spans, lambda v: v.k IN ({', '.join(str(_PLACES[kind]) for kind in secret_scan.BASE)}))")}) AS base_sha256,
            {_LISTED.format("spans")} AS spans
        FROM found""",
    "op10_line_dedup": _LINE_DEDUP,
    "op11_bit_sliced_resample": rf"""
        WITH {_CRC_TABLE}, docs AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), aims AS (
            SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
        ), uses AS (
            SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM docs) GROUP BY ALL
        ), names AS (
            SELECT w, {_crc32("w")} % {resample.BUCKETS} AS bucket FROM tab, (SELECT w FROM uses UNION SELECT w FROM aims)
        ), raw AS (
            SELECT bucket, sum(n) AS s FROM uses JOIN names USING (w) GROUP BY bucket
        ), aimed AS (
            SELECT bucket, count(*) AS t FROM aims JOIN names USING (w) GROUP BY bucket
        ), sums AS (
            SELECT CAST(coalesce((SELECT sum(s) FROM raw), 0) AS DOUBLE) AS ss, CAST(coalesce((SELECT sum(t) FROM aimed), 0) AS DOUBLE) AS ts
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (ss + {resample.BUCKETS}) / ((coalesce(s, 0) + 1.0::DOUBLE) * (ts + {resample.BUCKETS})))) AS BIGINT) AS gain
            FROM sums, raw FULL JOIN aimed USING (bucket)
        ), weights AS (
            SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS total FROM uses JOIN names USING (w) JOIN gains USING (bucket) GROUP BY doc_id
        ), weighed AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS weight,
                CAST('0x' || left(sha256('{resample.SEED}:' || doc_id), 8) AS BIGINT) AS h
            FROM docs LEFT JOIN weights USING (doc_id)
        ), scored AS (
            SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= {resample.LEAST_WORDS}
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {resample.PERCENT} * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE}, docs AS (
            SELECT doc_id, coalesce('1' || source, '0') AS g, {_leaf("text")} AS leaf,
                CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS tampered
            FROM documents, tab
        ), rows AS (
            SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM docs
        ), nodes AS (
            SELECT 0 AS level, g, r, n, leaf AS h FROM rows
            UNION ALL
            SELECT level + 1, g, r // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY r)) FROM nodes WHERE n > 1 GROUP BY level, g, r // 3, n
        ), subroots AS (
            SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS level, r, n, h FROM subroots
            UNION ALL
            SELECT level + 1, r // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY r)) FROM tops WHERE n > 1 GROUP BY level, r // 3, n
        ), levels AS (
            SELECT level, g, r, n, h FROM nodes UNION ALL SELECT 1000 + level, NULL, r, n, h FROM tops
        ), sides AS (
            SELECT a.level, a.g, a.r, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (WHERE b.r < a.r), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (WHERE b.r > a.r), '') AS behind
            FROM levels a JOIN levels b ON a.level = b.level AND a.g IS NOT DISTINCT FROM b.g AND a.r // 3 = b.r // 3 WHERE a.n > 1 GROUP BY a.level, a.g, a.r
        ), steps AS (
            SELECT d.g, d.r, s.level, s.before, s.behind FROM rows d JOIN sides s ON d.g = s.g AND s.r = d.r // CAST(3 ** s.level AS BIGINT)
            UNION ALL
            SELECT d.g, d.r, s.level, s.before, s.behind FROM rows d JOIN subroots o USING (g) JOIN sides s ON s.level >= 1000 AND s.r = o.r // CAST(3 ** (s.level - 1000) AS BIGINT)
        ), paths AS (
            SELECT g, r, sha256(string_agg(before || behind, '' ORDER BY level)) AS proof, list({{'before': before, 'behind': behind}} ORDER BY level) AS path FROM steps GROUP BY g, r
        ), folds AS (
            SELECT g, r, 1 AS k, tampered AS h, coalesce(path, []) AS path FROM rows LEFT JOIN paths USING (g, r)
            UNION ALL
            SELECT g, r, k + 1, sha256(path[k].before || h || path[k].behind), path FROM folds WHERE k <= len(path)
        )
        SELECT d.doc_id, d.leaf, s.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
        FROM rows d JOIN subroots s USING (g) JOIN (SELECT h FROM tops WHERE n = 1) t ON true
        JOIN (SELECT * FROM folds WHERE k > len(path)) f ON f.g = d.g AND f.r = d.r LEFT JOIN paths p ON p.g = d.g AND p.r = d.r""",
    "op9_cover_tree_dedup": f"""
        WITH RECURSIVE live AS (
            SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.id AS a, b.id AS b FROM live a JOIN live b ON a.id <> b.id
            WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= {cover_tree.THRESHOLD} ELSE false END
        ), reached AS (
            SELECT vec_id AS id, vec_id AS other FROM embeddings WHERE vec_id IS NOT NULL
            UNION
            SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a
        ), components AS (
            SELECT id, min(other) AS component_id FROM reached GROUP BY id
        ), degrees AS (
            SELECT a AS id, count(*) AS n FROM links GROUP BY a
        )
        SELECT c.id AS vec_id, coalesce(d.n, 0) AS n_links, c.component_id, c.id = c.component_id AS kept
        FROM components c LEFT JOIN degrees d USING (id)""",
}
