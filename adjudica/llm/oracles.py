"""SQL for the operators' queries, as far as SQL can say what they return, on tables of a size SQL can handle."""

from __future__ import annotations

from adjudica.llm import license_scan as L
from adjudica.llm import quality_rules as Q

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: connected components of links(a, b), both ways: every node with the smallest it can reach
REACH = "reach(id, pos) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.pos = both_ways.a), component AS (SELECT id, min(pos) AS c FROM reach GROUP BY id)"


def crc32(text: str) -> str:
    """Unsigned checksum of a text's UTF-8 bytes, bit by bit."""
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    # an octet of the hexadecimal form at a time
    octets = f"list_transform(range(1, length(hex(encode({text}))), 2), lambda i: ('0x' || hex(encode({text}))[i:i + 1])::bigint)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {octets}), lambda a, b: {byte}), 4294967295)"


def substring_dedup(window: int = 13) -> str:
    """All windows, as strings."""
    return (
        f"WITH d AS (SELECT doc_id, {WORDS.format('coalesce(text, %s)' % repr(''))} AS w FROM documents), "
        f"win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {window - 1}], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM d WHERE len(w) >= {window})), "
        "first AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k), "
        f"gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN first USING (k), range({window}) t(j) WHERE low < doc_id), "
        "kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id) "
        "SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"
    )


def license_scan() -> str:
    values = ", ".join(f"('{label}', {number}, {n}, {i}, '{g}', {str(must).lower()})" for label, number, n, i, g, must in L.template_grams())
    phrases = ", ".join(f"('{label}', '{p}', {len(p.split())})" for p, label in L.PHRASES.items())
    return (
        rf"WITH d AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents), t(label, number, n, t_at, gram, must) AS (VALUES {values}), needed AS (SELECT label, number, count(*) FILTER (must) AS needed FROM t GROUP BY 1, 2), three AS (SELECT DISTINCT gram FROM t), phrase(label, p, n) AS (VALUES {phrases}), "
        "u AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), "
        "base AS (SELECT doc_id, label, i - 1 AS pos FROM u JOIN phrase ON array_to_string(w[i:i + n - 1], ' ') = p), "
        "b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM base GROUP BY 1), "
        f"g AS (SELECT doc_id, i, array_to_string(w[i:i + {L.K - 1}], ' ') AS gram FROM u), hit AS (SELECT doc_id, label, number, n, i - 1 AS pos, t_at, must, i - 1 - t_at AS dg FROM (SELECT g.* FROM g SEMI JOIN three USING (gram)) JOIN t USING (gram)), "
        f"line AS (SELECT *, CASE WHEN dg - lag(dg) OVER one > {L.NEAR} OR lag(dg) OVER one IS NULL THEN 1 ELSE 0 END AS fresh FROM (SELECT DISTINCT doc_id, label, number, dg FROM hit) WINDOW one AS (PARTITION BY doc_id, label, number ORDER BY dg)), "
        "island AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, label, number ORDER BY dg ROWS UNBOUNDED PRECEDING) AS island FROM line), "
        f"span AS (SELECT doc_id, label, number, n, island, min(pos) AS a, max(pos) + {L.K - 1} AS z, count(DISTINCT t_at + j) AS covered, count(DISTINCT t_at) FILTER (must) AS told FROM hit JOIN island USING (doc_id, label, number, dg), range({L.K}) r(j) GROUP BY 1, 2, 3, 4, 5), "
        f"found AS (SELECT doc_id, list(DISTINCT label) AS more, max(cast(covered AS double) / n) AS cover FROM span JOIN needed USING (label, number) WHERE told >= needed AND cast(covered AS double) / n >= {L.LEAST_COVER} AND z - a < 2 * n GROUP BY doc_id) "
        "SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, array_to_string(list_sort(coalesce(labels, [])), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(more, [])))), ',') AS labels, "
        "CASE WHEN n_base > 0 THEN 1.0::double ELSE coalesce(cover, 0.0) END AS score FROM d LEFT JOIN b USING (doc_id) LEFT JOIN found USING (doc_id)"
    )


def quality_rules() -> str:
    return (
        f"WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format('coalesce(text, %s)' % repr(''))} AS w FROM documents), "
        r"l AS (SELECT doc_id, source, line, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)), "
        "who AS (SELECT doc_id, md5(array_to_string(w, ' ')) AS who FROM d), hosts AS (SELECT source, count(DISTINCT who) AS all_docs FROM d JOIN who USING (doc_id) GROUP BY source), "
        "lines AS (SELECT source, norm, count(DISTINCT who) AS n_docs FROM l JOIN who USING (doc_id) WHERE n > 0 GROUP BY source, norm), "
        f"frequent AS (SELECT lines.source, norm FROM lines JOIN hosts ON hosts.source IS NOT DISTINCT FROM lines.source WHERE n_docs > {Q.LEAST_DOCS} AND n_docs > {Q.LEAST_SHARE} * all_docs), "
        "gone AS (SELECT doc_id, count(*) AS lines, sum(n) AS words FROM l JOIN frequent f ON f.norm = l.norm AND f.source IS NOT DISTINCT FROM l.source WHERE n > 0 GROUP BY doc_id), "
        "dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE n > 0 GROUP BY doc_id), "
        "five AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 4], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)), "
        "twice AS (SELECT doc_id, i FROM five QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1), rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(5) t(j) GROUP BY doc_id), "
        "s AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.lines, 0) AS n_removed_lines, cast(len(w) - coalesce(gone.words, 0) AS bigint) AS n_left_words FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)) "
        f"SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_left_words < n_words AND (n_left_words < {Q.LEFT_WORDS} OR n_left_words < {Q.LEFT_SHARE} * n_words)) AS kept FROM s"
    )


def mixing(seed: int = 17, shard_words: int = 1024, block: int = 1024, least_blocks: int = 64) -> str:
    """Targets by trying every number of capped sources; seats by ranking every quotient there is."""
    seeded = "cast('0x' || substr(md5({0}), 1, 15) AS bigint)"
    return (
        f"WITH d AS (SELECT doc_id, source, len({WORDS.format('coalesce(text, %s)' % repr(''))}) AS size, {seeded.format(f"'{seed}:' || doc_id")} AS ord FROM documents), "
        "src AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source), "
        "wt AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::double AS weight FROM src), "
        "lv AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS level FROM wt), "
        "fl AS (SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS fill FROM lv WINDOW b AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        "fill AS (SELECT arg_min(fill, level) AS f FROM fl WHERE level > fill), "
        "tg AS (SELECT source, source_size, weight, CASE WHEN f IS NULL OR level <= f THEN cap ELSE f * weight END::double AS target FROM lv, fill), "
        f"bl AS (SELECT cast(least({block}, greatest(1, min(target) FILTER (target > 0) // {least_blocks})) AS bigint) AS b FROM tg), "
        "q AS (SELECT source, target / (2 * k - 1) AS q, k FROM (SELECT source, target, unnest(range(1, cast(floor(2.0 * source_size / b) AS bigint) + 1)) AS k FROM tg, bl)), "
        "house AS (SELECT least(floor(sum(target) / any_value(b) + 0.5), sum(least(floor(target / b + 0.5), floor(2.0 * source_size / b)))) AS h FROM tg, bl), "
        "seats AS (SELECT source, count(*) AS seats FROM (SELECT * FROM q QUALIFY row_number() OVER (ORDER BY q DESC, source NULLS LAST, k) <= (SELECT h FROM house)) GROUP BY source), "
        f"p AS (SELECT d.*, source_size, target, ord % cast(greatest(1, ceil(sqrt(source_size / {shard_words}))) AS bigint) AS shard FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source), "
        "sh AS (SELECT source, shard, sum(size)::bigint AS shard_size FROM p GROUP BY source, shard), "
        "sc AS (SELECT sh.*, cast(floor(2.0 * shard_size / b) AS bigint) AS cap, coalesce(seats, 0) AS house FROM sh JOIN bl ON true LEFT JOIN seats ON sh.source IS NOT DISTINCT FROM seats.source), "
        "sq AS (SELECT source, shard, least(house, sum(cap) OVER (PARTITION BY source)) AS house, cap, shard_size FROM sc), "
        "ss AS (SELECT source, shard, count(*) AS seats FROM (SELECT * FROM (SELECT source, shard, house, shard_size, unnest(range(1, cap + 1)) AS k FROM sq) QUALIFY row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k - 1) DESC, shard, k) <= house) GROUP BY source, shard), "
        f"c AS (SELECT sh.*, coalesce(seats, 0) * b AS words, {seeded.format(f"'{seed}:' || coalesce(sh.source, '') || ':' || sh.shard")} AS seed FROM sh JOIN bl ON true LEFT JOIN ss ON sh.source IS NOT DISTINCT FROM ss.source AND sh.shard = ss.shard), "
        "r AS (SELECT source, shard, shard_size, CASE WHEN shard_size = 0 THEN 0 ELSE words // shard_size END AS whole, CASE WHEN shard_size = 0 THEN 0 ELSE words % shard_size END AS rest, CASE WHEN shard_size = 0 THEN 0 ELSE seed % shard_size END AS start FROM c), "
        "o AS (SELECT p.*, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM p) "
        "SELECT doc_id, o.source, size, source_size, target, cast(whole * size + greatest(least(begin + size, start + rest, shard_size) - greatest(begin, start), 0) + greatest(least(begin + size, start + rest - shard_size) - begin, 0) AS bigint) AS taken FROM o JOIN r ON o.source IS NOT DISTINCT FROM r.source AND o.shard = r.shard"
    )


def embedding_dedup(threshold: float = 0.98) -> str:
    return (
        "WITH RECURSIVE v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0), "
        f"links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id < b.vec_id WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= {threshold}), "
        f"both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), n AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a), {REACH} "
        "SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN component ON component.id = vec_id"
    )


def minhash_dedup(shingle: int = 3, percent: int = 85) -> str:
    return (
        f"WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(ASCII_LOWER)} AS w FROM documents), "
        f"sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {shingle} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {shingle - 1}], ' ') END AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 2}, 2))) AS i FROM d WHERE len(w) > 0)), "
        "n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2), "
        f"links AS (SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), {REACH} "
        "SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN component ON component.id = doc_id"
    )


def decontamination(window: int = 10) -> str:
    """Windows as word lists, at every place of every length they have."""
    words = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return (
        f"WITH item AS (SELECT cast(item_id AS varchar) AS item, {words} AS w FROM benchmark), d AS (SELECT doc_id, {words} AS w FROM documents), "
        f"win AS (SELECT DISTINCT item, array_to_string(w[i:i + {window - 1}], ' ') AS gram, least(len(w), {window}) AS k FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS i FROM item WHERE len(w) > 0)), "
        "size AS (SELECT DISTINCT k FROM win), place AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, size WHERE len(w) >= k)), "
        "hit AS (SELECT doc_id, i, k, item FROM place JOIN win USING (k, gram)), n AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(k)) AS j FROM hit) GROUP BY doc_id), "
        "items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit WHERE item IS NOT NULL) GROUP BY doc_id) "
        "SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)"
    )


def hard_negatives(positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """All scores of the anchors, ranked."""
    return (
        "WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: cast(floor(256 * x::double) AS bigint)) AS q FROM embeddings "
        "WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), a AS (SELECT * FROM e WHERE vec_id % 50 = 0), "
        "s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS alike, cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * e.q[i])) AS bigint) AS score FROM a, e WHERE len(a.q) = len(e.q)), "
        f"p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike AND other <> anchor_id QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {positives}) "
        "SELECT anchor_id, positive_id, cast(row_number() OVER one AS int) AS rank, other AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id) "
        f"WHERE NOT alike AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score WINDOW one AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER one <= {negatives}"
    )


def spelling_variants() -> str:
    """Near words are the same without one letter at one place, or one is the other without a letter."""
    runs = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')"
    return (
        f"WITH RECURSIVE r AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest({runs}) AS w FROM documents) WHERE length(w) >= 6 GROUP BY doc_id, w), "
        f"h AS (SELECT w, c, {crc32("coalesce(cast(doc_id AS varchar), '') || ':' || w")} AS h FROM r), "
        "k AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, cast(h % length(w) AS bigint)) || substr(w, cast(h % length(w) AS bigint) + 2) ELSE w END AS word, c FROM h), "
        "v AS (SELECT word, cast(sum(c) AS bigint) AS n FROM k WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5), "
        "less AS (SELECT word, n, pos, CASE WHEN pos = 0 THEN word ELSE left(word, pos - 1) || substr(word, pos + 1) END AS part FROM (SELECT word, n, unnest(range(length(word) + 1)) AS pos FROM v)), "
        "near AS (SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n FROM less x JOIN less y ON x.part = y.part AND x.word <> y.word AND (x.pos = y.pos OR x.pos = 0 OR y.pos = 0)), "
        "best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, arg_min(other_n, (-other_n, other)) AS form_n FROM near GROUP BY word), "
        "form AS (SELECT word, n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM best), "
        "way(word, pos) AS (SELECT word, form FROM form WHERE form IS NOT NULL UNION ALL SELECT way.word, form.form FROM way JOIN form ON form.word = way.pos WHERE form.form IS NOT NULL), "
        "root AS (SELECT word, pos AS root FROM way ANTI JOIN (SELECT word AS pos FROM form WHERE form IS NOT NULL) USING (pos)) "
        "SELECT v.word, form, coalesce(root, v.word) AS root, n, coalesce(n_near, 0) AS n_near, form_n FROM v LEFT JOIN form ON form.word = v.word LEFT JOIN root ON root.word = v.word"
    )


def pii() -> str:
    """The four strict kinds: matches by kind with their places, from the lengths of what stands between them."""
    part = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN cast({digits}[-i] AS int) WHEN cast({digits}[-i] AS int) > 4 THEN 2 * cast({digits}[-i] AS int) - 9 ELSE 2 * cast({digits}[-i] AS int) END)) % 10 = 0"
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(m, '{part}\.{part}\.{part}\.{part}')"),
        "card": (r"[0-9]([\x20-]?[0-9])+", f"length({digits}) BETWEEN 14 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 10 AND 15"),
    }
    found = []
    for n, (kind, (pattern, check)) in enumerate(kinds.items()):
        cut = f"SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found, string_split(regexp_replace(text, '{pattern}', chr(1), 'g'), chr(1)) AS parts FROM d"
        places = "SELECT doc_id, found[k] AS m, cast(list_sum(list_transform(parts[1:k], lambda p: length(p))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda p: length(p))), 0) AS bigint) AS a FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM c)"
        found.append(f"SELECT doc_id, {n} AS n, '{kind}' AS kind, a, a + length(m) AS z FROM (WITH c AS ({cut}) {places}) WHERE {check}")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), s AS ({' UNION ALL '.join(found)}), g AS (SELECT doc_id, {counts}, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, n) AS spans FROM s GROUP BY doc_id) "
        f"SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in kinds)}, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN g USING (doc_id)"
    )


def hmm_lm() -> str:
    """What the model rests on: held-out rows by crc32, counts of training tokens and the base score."""
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id AS varchar), ''), lambda c: ascii(c)::bigint)), lambda a, b: {byte}), 4294967295)"
    return (
        f"WITH d AS (SELECT doc_id, coalesce({crc} % 7 = 2, false) AS held_out, list_append({WORDS.format(ASCII_LOWER)}, chr(10)) AS w FROM documents), t AS (SELECT doc_id, held_out, unnest(w) AS word FROM d), "
        "c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word), n AS (SELECT sum(c)::bigint AS n, count(*) AS v FROM c) "
        "SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10((coalesce(c, 0) + 1) / (n + v + 1.0::double))), 4) AS base_score FROM t LEFT JOIN c USING (word), n GROUP BY doc_id, held_out"
    )
