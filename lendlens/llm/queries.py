"""The registered queries of this subpackage: thin digests of the operators
over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import _shared as S
from . import (arrow_tokens, conversation_trie, decontaminate, embedding_dedup, licences, minhash, packing, pii,
               quality, substring_dedup, topk_search, warc, whitening)


def op1_pii_boosting(spark, sf_dir):
    """Personal data in every document: base spans, and those the trees add."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def build():
        spotted = S.materialised(pii.spot(docs), "pii-spotted")
        return pii.judged(spotted, pii.fit(spotted))

    return S.tidy(spark, "pii", build)


def op2_quality_qda(spark, sf_dir):
    """Quality score of every document; labels of a fifth of the ids are never learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def build():
        described = S.materialised(quality.describe(docs), "quality-statistics")
        model = quality.fit(described, spark.read.parquet(f"{sf_dir}/labels.parquet"))
        return quality.score(described, model).select(
            "doc_id", quality.held_out().alias("held_out"), "score",
            (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))

    return S.tidy(spark, "quality", build)


def _as_files(docs):
    """Documents as a file tree: source/lang/hundred/name. Some ids are the
    licence files of their hundred, language or source."""
    i = F.col("doc_id")
    lang, hundred = F.concat_ws("/", "source", "lang"), F.floor(i / 100).cast("string")
    return docs.withColumn("path", (
        F.when(i % 2000 == 11, F.concat_ws("/", "source", F.concat(F.lit("LICENSE-"), i.cast("string"))))
        .when(i % 500 == 7, F.concat_ws("/", lang, F.concat(F.lit("LICENSE-"), i.cast("string"))))
        .when(i % 100 == 0, F.concat_ws("/", lang, hundred, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", lang, hundred, F.concat(i.cast("string"), F.lit(".txt"))))))


def op3_licence_scan(spark, sf_dir):
    """Licence of every document in a file tree of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return S.tidy(spark, "licences", lambda: licences.scan(_as_files(docs), keep=("doc_id",)))


def op4_warc_revisits(spark, sf_dir):
    """Every page as a WARC record, repeated payloads as revisits, read back.
    The archives go once their digests are written."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")

    def build():
        manifest = warc.write_archives(pages, S.shared_folder(spark, "warc"))
        return warc.read_archives(manifest, with_payload=False).drop("url")

    return S.tidy(spark, "warc", build)


def op5_superkmer_dedup(spark, sf_dir):
    """Passages of 35 words that occur elsewhere, removed from all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return S.tidy(spark, "superkmers", lambda: substring_dedup.remove_repeated(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")))


def op6_pivot_embeddings(spark, sf_dir):
    """Near-duplicate classes of all embeddings of equal label."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return S.tidy(spark, "embeddings", lambda: embedding_dedup.near_duplicates(vectors))


def op7_packing(spark, sf_dir):
    """Pieces of all documents packed into windows of 1024 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return S.tidy(spark, "packed", lambda: packing.pack(docs, keep_ids=False))


def op8_decontaminate(spark, sf_dir):
    """Words of all documents that occur in windows of benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = F.array_sort(F.transform("hits.items", lambda x: x.cast("string")))
    return S.tidy(spark, "decontaminated", lambda: decontaminate.find_hits(docs, items).select(
        "doc_id", F.col("hits.n_words").alias("n_words"), decontaminate.n_hit().alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hits.spans") > 0).alias("contaminated")))


def op9_minhash(spark, sf_dir):
    """Near-duplicate classes of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return S.tidy(spark, "minhash", lambda: minhash.near_duplicates(docs))


def op10_arrow_tokens(spark, sf_dir):
    """Ids of all documents written as Arrow stream files and read back. The
    files go once their digests are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def build():
        uri = S.shared_folder(spark, "arrow-tokens")
        return arrow_tokens.read_tokens(spark, uri, arrow_tokens.write_tokens(docs, uri))

    return S.tidy(spark, "arrow-tokens", build)


def op11_gkl_whitening(spark, sf_dir):
    """All embeddings on their 16 leading components, whitened."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")

    def build():
        rows, wide = whitening.prepare(vectors)
        return whitening.whiten(rows, wide, whitening.fit(rows, wide))

    return S.tidy(spark, "whitening", build)


def op12_conversation_trie(spark, sf_dir):
    """Nodes of the prefix trie of all rebuilt conversations."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return S.tidy(spark, "trie", lambda: conversation_trie.trie(conversation_trie.rebuilt(turns)))


def op13_topk_search(spark, sf_dir):
    """The five vectors that score highest for every fiftieth id."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return S.tidy(spark, "search", lambda: topk_search.search(vectors, F.col("vec_id") % 50 == 0))


QUERIES = {
    "op1_pii_boosting": op1_pii_boosting,
    "op2_quality_qda": op2_quality_qda,
    "op3_licence_scan": op3_licence_scan,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_superkmer_dedup": op5_superkmer_dedup,
    "op6_pivot_embeddings": op6_pivot_embeddings,
    "op7_packing": op7_packing,
    "op8_decontaminate": op8_decontaminate,
    "op9_minhash": op9_minhash,
    "op10_arrow_tokens": op10_arrow_tokens,
    "op11_gkl_whitening": op11_gkl_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_topk_search": op13_topk_search,
}

def _licence_sql() -> str:
    """The licence scan in DuckDB SQL, with the same fixed templates."""
    values = ", ".join("({}, '{}', '{}')".format(i, licence, text.replace("'", "''"))
                       for i, (licence, text) in enumerate(licences.TEMPLATES))
    lower = "translate({}, '" + licences.UPPER + "', '" + licences.LOWER + "')"
    return f"""
        WITH templates(template, licence, text) AS (VALUES {values}),
        tt AS (SELECT template, licence, unnest(regexp_extract_all({lower.format('text')}, '{licences.TOKEN}')) AS token
               FROM templates),
        tc AS (SELECT template, licence, token, count(*) AS tf FROM tt GROUP BY ALL),
        total AS (SELECT count(*) AS n FROM templates),
        idf AS (SELECT token, ln((1.0 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM tc, total GROUP BY token),
        tw AS (SELECT template, licence, token, tf * idf AS w,
                      sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY template)) AS norm FROM tc JOIN idf USING (token)),
        files AS (SELECT doc_id, text, CASE
              WHEN doc_id % 2000 = 11 THEN concat_ws('/', source, 'LICENSE-' || doc_id)
              WHEN doc_id % 500 = 7 THEN concat_ws('/', source, lang, 'LICENSE-' || doc_id)
              WHEN doc_id % 100 = 0 THEN concat_ws('/', source, lang, (doc_id // 100)::VARCHAR, 'LICENSE')
              ELSE concat_ws('/', source, lang, (doc_id // 100)::VARCHAR, doc_id || '.txt') END AS path FROM documents),
        units AS (SELECT path, row_number() OVER () AS unit, col FROM (
              SELECT path, unnest(string_split(regexp_replace({lower.format('text')},
                     '{licences.SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10))) AS col FROM files)
              WHERE regexp_matches(col, '{licences.LICENSING}')),
        q AS (SELECT path, unit, token, count(*) AS tf FROM (
              SELECT path, unit, unnest(regexp_extract_all(col, '{licences.TOKEN}')) AS token FROM units) GROUP BY ALL),
        qw AS (SELECT path, unit, q.token, tf * coalesce(idf, ln(1.0 + n) + 1) AS w
               FROM q LEFT JOIN idf USING (token), total),
        qn AS (SELECT path, unit, sqrt(sum(w * w)) AS norm FROM qw GROUP BY ALL),
        cosines AS (SELECT path, licence, round(sum(qw.w * tw.w) / (any_value(qn.norm) * any_value(tw.norm)), 6) AS cosine
              FROM qw JOIN tw USING (token) JOIN qn USING (path, unit) GROUP BY path, unit, template, licence),
        own AS (SELECT path, licence AS own_licence, cosine FROM cosines WHERE cosine >= {licences.THRESHOLD}
                QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, licence) = 1),
        listed AS (SELECT doc_id, path, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir
                   FROM files),
        declared AS (SELECT regexp_replace(path, '/[^/]*$', '') AS prefix, own_licence AS inherited FROM own
              WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{licences.LICENCE_FILE}')
              QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY cosine DESC, path) = 1),
        nearest AS (SELECT dir, prefix, inherited FROM (SELECT DISTINCT dir FROM listed) d
              JOIN declared ON prefix = '' OR dir = prefix OR starts_with(dir, prefix || '/')
              QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(prefix) DESC) = 1)
        SELECT doc_id, path, own_licence, cosine, coalesce(own_licence, inherited) AS licence,
               CASE WHEN own_licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited'
                    ELSE 'none' END AS origin,
               CASE WHEN own_licence IS NULL THEN prefix END AS inherited_from
        FROM listed LEFT JOIN own USING (path) LEFT JOIN nearest USING (dir)"""


_LOWER = f"translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}')"

ORACLE_SQL: dict[str, str] = {
    "op5_superkmer_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        win AS (SELECT doc_id, k, md5(array_to_string(ws[k:k + 34], ' ')) AS s
                FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS k FROM w)),
        again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS i FROM win JOIN again USING (s)),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id,
              regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
        bw AS (SELECT DISTINCT item_id, size, array_to_string(ws[k:k + size - 1], ' ') AS s
               FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS k FROM b)),
        sizes AS (SELECT DISTINCT size FROM b),
        dw AS (SELECT doc_id, size, k, array_to_string(ws[k:k + size - 1], ' ') AS s
               FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, sizes)),
        hits AS (SELECT doc_id, k, size, item_id FROM dw JOIN bw USING (size, s)),
        words AS (SELECT doc_id, count(*) AS n FROM (
                  SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS i FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
               coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               words.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_minhash": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS s
               FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS k FROM w)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y
                 ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
        links AS MATERIALIZED (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
                  WHERE 100 * i >= 85 * (na.n + nb.n - i)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION
                  SELECT r.doc_id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END
                  FROM reach r JOIN links l ON l.a = r.other OR l.b = r.other),
        c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM c LEFT JOIN n USING (doc_id)""",
    "op12_conversation_trie": r"""
        WITH ordered AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                 sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
               FROM conversations WHERE conv_id IS NOT NULL),
        crc_table(i, v) AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, _:
               CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FROM range(256) t(i)),
        crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc_table),
        convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
               FROM (SELECT DISTINCT conv_id FROM ordered), crc),
        turns AS (SELECT c.conv_id, o.role, o.text, o.k, 0 AS own FROM convs c JOIN ordered o
                    ON o.conv_id = c.base AND o.k <= c.h
                  UNION ALL SELECT c.conv_id, o.role, o.text, o.k, 1 FROM convs c JOIN ordered o
                    ON o.conv_id = c.conv_id AND o.k > c.h),
        numbered AS (SELECT conv_id, length(text) AS size, row_number() OVER w AS depth,
                  string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER w AS path
                  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)),
        prefixes AS MATERIALIZED (SELECT conv_id, depth::BIGINT AS depth, size, md5(path) AS node,
                  coalesce(lag(md5(path)) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM numbered
                  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
        nodes AS MATERIALIZED (SELECT node, depth, any_value(parent) AS parent, any_value(size) AS size,
                  min(conv_id) AS conv_id, count(*) AS n_convs FROM prefixes GROUP BY node, depth),
        children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        known AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
        below AS (SELECT p.node, sum((t.n_children = 0)::INT) AS n_leaves, sum((t.n_convs - 1) * t.size) AS saved
                  FROM known t JOIN prefixes p ON p.conv_id = t.conv_id AND p.depth <= t.depth GROUP BY p.node),
        ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
                 FROM (SELECT * FROM prefixes QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1)
                 GROUP BY node)
        SELECT k.conv_id, k.depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves::BIGINT AS n_leaves,
               saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM known k JOIN below USING (node) LEFT JOIN ends USING (node) LEFT JOIN nodes up ON up.node = k.parent""",
    "op13_topk_search": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c AS (SELECT r, vec_id, unnest(range(1, len(e) + 1)) AS i, floor(256 * unnest(e)::DOUBLE)::BIGINT AS x FROM v),
        p AS (SELECT r, vec_id FROM v),
        s AS (SELECT q.r AS qr, d.r AS r, sum(q.x * d.x)::BIGINT AS score
              FROM c q JOIN c d USING (i) WHERE q.vec_id % 50 = 0 GROUP BY ALL),
        pairs AS (SELECT q.r AS qr, q.vec_id AS query_id, d.vec_id, coalesce(score, 0) AS score
              FROM p q JOIN p d ON q.r <> d.r LEFT JOIN s ON s.qr = q.r AND s.r = d.r WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST)::INT
                   AS rank, vec_id, score FROM pairs)
        SELECT * FROM ranked WHERE rank <= 5""",
    "op3_licence_scan": _licence_sql(),
    "op4_warc_revisits": """
        WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h,
                          octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
             f AS (SELECT h, min(page_id) AS original FROM p GROUP BY h)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + ((('0x' || substr(p.h, (5 * (i // 4) + 1)::INT, 5))::BIGINT
                       >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
               CASE WHEN original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to
        FROM p JOIN f USING (h)""",
}
