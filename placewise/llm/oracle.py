"""SQL that gives the same rows as the queries of this folder, where SQL can.

Scores of trained models, packing, tokens and record files have no SQL form; tests hold
these queries against brute force and round trips.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _crc32(codes: str) -> str:
    """The unsigned CRC-32 of a list of bytes."""
    shifted = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    step = f"list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {shifted})"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda crc, byte: {step}), 4294967295)"


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"


def _latin(text: str) -> str:
    """The bytes in UTF-8 of a text of code points below 256."""
    code = "CAST(unicode(c) AS BIGINT)"
    return f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [{code}] ELSE [192 + ({code} >> 6), 128 + ({code} & 63)] END))"


def _leaf(*fields: str) -> str:
    parts = (f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')" for f in fields)
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, bottom: str, levels: int) -> str:
    """Tables ``name0`` to ``name<levels>``: the nodes of each level and their parents' places."""
    tables = [f"{name}0 AS ({bottom})"]
    for level in range(levels):
        tables.append(f"""{name}{level + 1} AS (
            SELECT tree, place // 16 AS place, CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,
                   (any_value(size) + 15) // 16 AS size FROM {name}{level} GROUP BY tree, place // 16)""")
    return ",\n        ".join(tables)


def _siblings(name: str, levels: int) -> str:
    """Each node's siblings on the way up in a row, and the digest that ``held`` gives at the top."""
    tables = [f"{name}_way0 AS (SELECT *, place AS spot, '' AS proof, held AS folded FROM {name}_start)"]
    for level in range(levels):
        tables.append(f"""{name}_way{level + 1} AS (
            SELECT w.* REPLACE (w.spot // 16 AS spot,
                   w.proof || CASE WHEN n.size = 1 THEN '' ELSE coalesce(o.before, '') || coalesce(o.after, '') END AS proof,
                   CASE WHEN n.size = 1 THEN w.folded ELSE sha256(coalesce(o.before, '') || w.folded || coalesce(o.after, '')) END AS folded)
            FROM {name}_way{level} w JOIN {name}{level} n ON n.tree = w.tree AND n.place = w.spot
            JOIN (SELECT tree, place, string_agg(digest, '') OVER (PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
                         string_agg(digest, '') OVER (PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
                  FROM {name}{level}) o ON o.tree = w.tree AND o.place = w.spot)""")
    return ",\n        ".join(tables)


# Levels of the Merkle trees: 16 to this power rows of a source and sources.
_LEVELS = 5

SQL = {
    "op1_quality_rules": rf"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS run
                    FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 6))) AS i FROM w)),
        twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM windows),
        repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
                    FROM twice, (SELECT unnest(range(8)) AS j) WHERE n > 1 GROUP BY doc_id),
        lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
                  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        counts AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                          len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                          len(regexp_extract_all(text, '[A-Za-z]|[^\x00-\x7F]')) AS n_letters,
                          len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS n_same,
                          coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                          coalesce(n_repeat_words, 0) AS n_repeat_words
                   FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
                    OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                    OR 100 * n_same > 20 * n_words OR 100 * n_letters < 60 * word_chars) AS kept
        FROM counts""",
    "op4_substring_dedup": rf"""
        WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
                    FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 11))) AS i FROM w)),
        first AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS least FROM windows),
        gone AS (SELECT DISTINCT doc_id, i + j AS place FROM first, (SELECT unnest(range(13)) AS j) WHERE least < doc_id),
        word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
        kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
                 FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op5_decontamination": rf"""
        WITH w AS (SELECT doc_id, {_ALNUM_WORDS} AS words FROM documents),
        items AS (SELECT item_id, {_ALNUM_WORDS} AS words FROM benchmark),
        windows AS (SELECT DISTINCT item_id, words[i:i + 9] AS own
                    FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)),
        runs AS (SELECT item_id, len(own) AS size, array_to_string(own, ' ') AS run FROM windows),
        found AS (SELECT DISTINCT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS run
                  FROM (SELECT doc_id, words, size, unnest(range(1, greatest(1, len(words) - size + 2))) AS i
                        FROM w, (SELECT DISTINCT size FROM runs))
                  WHERE array_to_string(words[i:i + size - 1], ' ') IN (SELECT run FROM runs)),
        hits AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit
                 FROM (SELECT doc_id, i, unnest(range(size)) AS j FROM found) GROUP BY doc_id),
        of_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                     FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found JOIN runs USING (run)) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN of_items USING (doc_id)""",
    "op6_tool_calls": """
        WITH calls AS (SELECT conv_id, turn, text, concat_ws('-', conv_id, turn) AS call_id FROM conversations WHERE role = 'user'),
        chains AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM calls),
        deep AS (SELECT *, row_number() OVER (PARTITION BY conv_id, chain, turn % 2 ORDER BY turn) - 1 AS depth FROM chains),
        results AS (SELECT conv_id, turn - 1 AS turn, count(*) AS n, min(text) AS content
                    FROM conversations WHERE role = 'assistant' GROUP BY ALL)
        SELECT conv_id, call_id, depth, coalesce(n, 0) AS n_results,
               CASE WHEN text IS NULL THEN 'missing argument text' END AS fault,
               sha256('{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"text":' || CAST(to_json(text) AS VARCHAR) || ',' END
                      || '"turn":' || turn
                      || CASE WHEN text IS NULL THEN '' ELSE ',"words":' || len([w FOR w IN string_split(text, ' ') IF w <> '']) END
                      || '},"call_id":"' || call_id || '","result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
                      || ',"tool":"answer"}') AS json_sha256
        FROM deep LEFT JOIN results USING (conv_id, turn)""",
    "op7_ngram_jaccard": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
                     FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
                   WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
        reached AS (SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
        least AS (SELECT a AS doc_id, min(b) AS b FROM reached GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
        FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op11_merkle_manifest": rf"""
        WITH docs AS (SELECT *, {_crc32(_ascii("CAST(doc_id AS VARCHAR)"))} % 5 = 0 AS tampered FROM documents),
        made AS (SELECT doc_id, source, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
                        {_leaf("doc_id", "source", "lang", "n_chars", "CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS held
                 FROM docs),
        placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                          row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                          count(*) OVER (PARTITION BY source) AS size FROM made),
        {_tree("own", "SELECT tree, place, leaf AS digest, size FROM placed", _LEVELS)},
        {_tree("top", f"SELECT -1 AS tree, tree AS place, digest, (SELECT count(DISTINCT tree) FROM placed) AS size FROM own{_LEVELS}", _LEVELS)},
        own_start AS (SELECT * FROM placed),
        {_siblings("own", _LEVELS)},
        top_start AS (SELECT doc_id, leaf, digest AS subroot, proof AS below, -1 AS tree, w.tree AS place, folded AS held
                      FROM own_way{_LEVELS} w JOIN own{_LEVELS} o ON o.tree = w.tree),
        {_siblings("top", _LEVELS)}
        SELECT doc_id, leaf, subroot, digest AS root, sha256(below || proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified,
               CAST(length(below || proof) // 64 AS INTEGER) AS n_siblings
        FROM top_way{_LEVELS}, (SELECT digest FROM top{_LEVELS})""",
    "op12_exact_top_k": """
        WITH taken AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
                       FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        terms AS (SELECT row, vec_id, unnest(w) AS weight, generate_subscripts(w, 1) AS term FROM taken),
        scores AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(sum(q.weight * c.weight) AS BIGINT) AS score
                   FROM terms q JOIN terms c USING (term) WHERE q.vec_id % 100 = 0 AND q.row <> c.row GROUP BY q.row, q.vec_id, c.row, c.vec_id)
        SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores)
        WHERE rank <= 10""",
    "op13_spelling_variants": rf"""
        WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]{{5,}}')) AS run FROM documents),
        hashed AS (SELECT doc_id, run, {_crc32(_latin("CAST(doc_id AS VARCHAR) || ':' || run"))} AS h FROM (SELECT DISTINCT doc_id, run FROM runs)),
        found AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
                  FROM runs JOIN hashed USING (doc_id, run)),
        words AS (SELECT word, count(*) AS n FROM found WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
        cuts AS (SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
                 FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (size, i, cut) WHERE a.word <> b.word
                  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON words.word = cut
                  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON words.word = cut),
        near AS (SELECT p.word, count(*) AS n_near, arg_max(w.word, (w.n, [-unicode(c) FOR c IN string_split(w.word, '')] || [1])) AS best, max(w.n) AS best_n
                 FROM pairs p JOIN words w ON w.word = p.other GROUP BY p.word),
        forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
                  FROM words LEFT JOIN near USING (word)),
        ways AS (SELECT word, word AS last, 0 AS steps FROM words UNION ALL SELECT ways.word, form, steps + 1 FROM ways JOIN forms ON forms.word = ways.last WHERE form IS NOT NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(last, steps) AS root FROM ways GROUP BY word) USING (word)""",
}
