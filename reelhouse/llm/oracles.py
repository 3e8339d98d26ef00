"""DuckDB SQL for the operators that SQL can express, made from their own parameters."""

from __future__ import annotations

from . import license_scan, mixing, resampling

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _hashed(digits: int, text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def source_mix(mix: mixing.Mix = mixing.Mix()) -> str:
    """The words a mix takes of every document."""
    b, n = mix.block_words, len(mix.weights)
    weight = f"CASE (number - 1) % {n} " + " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mix.weights)) + " END"
    primes = ", ".join(map(str, mixing.PRIMES))
    digits = len(f"{mix.buckets - 1:x}")
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
    WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
    summed AS (
        SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
        FROM sized GROUP BY source),
    weighed AS (SELECT *, number - 1 AS source_no, {weight} AS weight, {mix.most_repeats} * source_size AS cap FROM summed),
    levels AS (SELECT *, cap / weight AS level FROM weighed),
    rates AS (
        SELECT *, (CAST(SUM(source_size) OVER () AS BIGINT)
                   - CAST(COALESCE(SUM(cap) OVER (ORDER BY level, source_no {before}), 0) AS BIGINT))
                  / CAST(SUM(weight) OVER (ORDER BY level, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rate
        FROM levels),
    targets AS (
        SELECT source, source_no, source_size,
               COALESCE(LEAST(CAST(cap AS DOUBLE), weight * (
                   SELECT rate FROM rates WHERE rate <= level ORDER BY level, source_no LIMIT 1)), 0.0) AS target
        FROM rates),
    counted AS (
        SELECT source_no, CAST(ceil(round(target) / {b}) AS BIGINT) AS need, CAST(ceil(source_size / {b}) AS BIGINT) AS blocks,
               CAST(round(target) AS BIGINT) AS words
        FROM targets WHERE source_size > 0),
    needs AS (SELECT *, CAST(COALESCE(SUM(need) OVER (ORDER BY source_no {before}), 0) AS BIGINT) AS first FROM counted),
    slots AS (
        SELECT slot, {_hashed(15, f"'{mix.seed}:' || slot")} % (SELECT CAST(SUM(need) AS BIGINT) FROM needs) AS pick
        FROM (SELECT unnest(range((SELECT CAST(SUM(need) AS BIGINT) FROM needs))) AS slot)),
    drawn AS (
        SELECT slot, source_no, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS k
        FROM slots JOIN needs ON pick >= first AND pick < first + need),
    got AS (
        SELECT needs.*, COALESCE(got, 0) AS got
        FROM needs LEFT JOIN (SELECT source_no, COUNT(*) AS got FROM drawn GROUP BY source_no) USING (source_no)),
    placed AS (
        SELECT *, COALESCE(SUM(GREATEST(got - need, 0)) OVER (ORDER BY source_no {before}), 0) AS over_before,
               COALESCE(SUM(GREATEST(need - got, 0)) OVER (ORDER BY source_no {before}), 0) AS short_before
        FROM got),
    spare AS (
        SELECT CAST(short_before + i AS BIGINT) AS over, source_no AS to_no, got + i AS to_k
        FROM (SELECT *, unnest(range(need - got)) AS i FROM placed WHERE need > got)),
    settled AS (
        SELECT COALESCE(to_no, source_no) AS source_no, COALESCE(to_k, k) AS k
        FROM (SELECT d.source_no, d.k, CASE WHEN k >= need THEN CAST(over_before + k - need AS BIGINT) END AS over
              FROM drawn d JOIN placed USING (source_no)) LEFT JOIN spare USING (over)),
    remainders AS (
        SELECT source_no, p % blocks AS r, row_number() OVER (
                   PARTITION BY source_no ORDER BY abs(p % blocks - CAST(floor(blocks * 0.618) AS BIGINT)), p % blocks) - 1 AS place
        FROM needs, (SELECT unnest([{primes}]) AS p)),
    chosen AS (
        SELECT source_no, epoch, (r * CAST(k % blocks AS HUGEINT) + {_hashed(15, f"'{mix.seed}:' || source_no || ':' || epoch")} % blocks) % blocks AS block,
               CASE WHEN k = need - 1 THEN words - (need - 1) * {b} ELSE {b} END AS words
        FROM (SELECT *, k // blocks AS epoch FROM settled JOIN needs USING (source_no))
             JOIN remainders USING (source_no) WHERE place = epoch % {len(mixing.PRIMES)}),
    streams AS (
        SELECT doc_id, size, source_no, source_size, target, row_number() OVER () AS row,
               CAST(COALESCE(SUM(size) OVER (PARTITION BY source_no
                   ORDER BY {_hashed(digits, "coalesce(CAST(doc_id AS VARCHAR), '')")} % {mix.buckets}, doc_id NULLS FIRST, size {before}), 0) AS BIGINT) AS start
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
    parts AS (SELECT row, source_no, start, size, unnest(range(start // {b}, (start + size - 1) // {b} + 1)) AS block FROM streams WHERE size > 0),
    taken AS (
        SELECT row, SUM(GREATEST(LEAST(block * {b} + words, start + size) - GREATEST(block * {b}, start), 0)) AS taken
        FROM parts JOIN chosen USING (source_no, block) GROUP BY row)
    SELECT doc_id, size, source_size, target, CAST(COALESCE(taken, 0) AS BIGINT) AS taken FROM streams LEFT JOIN taken USING (row)"""


def license_labels(scan: license_scan.Scan = license_scan.Scan()) -> str:
    """Phrases at every place, and notices in every block."""
    known = license_scan.templates({t: 0 for x in [*license_scan.PHRASES, *license_scan.TEMPLATES.values()] for t in x.split()}, scan)
    stride = max(len(k.text.split()) for k in known)
    rows = lambda kind: ", ".join(f"('{k.label}', '{k.text}', {k.least})" for k in known if k.kind == kind)
    return rf"""
    WITH read AS (
        SELECT row_number() OVER () AS row, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    phrases AS (SELECT label, string_split(text, ' ') AS phrase FROM (VALUES {rows("phrase")}) AS p(label, text, least)),
    places AS (
        SELECT row, label, i
        FROM (SELECT row, words, label, phrase, unnest(range(len(words) - len(phrase) + 1)) AS i FROM read, phrases WHERE list_contains(words, phrase[1]))
        WHERE words[i + 1] = phrase[1] AND words[i + 1 : i + len(phrase)] = phrase),
    base AS (SELECT row, COUNT(*) AS n, MIN(i) AS first_word, MAX(i) AS last_word FROM places GROUP BY row),
    notices AS (SELECT label, list_distinct(string_split(text, ' ')) AS tokens, least FROM (VALUES {rows("notice")}) AS t(label, text, least)),
    blocks AS (
        SELECT row, list_distinct(words[first + 1 : first + {2 * stride}]) AS block
        FROM (SELECT row, words, unnest(range(0, greatest(len(words) - 1 - {stride}, 0) + 1, {stride})) AS first FROM read)),
    found AS (
        SELECT row, label, len(list_intersect(block, tokens)) / len(tokens) AS share
        FROM blocks, notices WHERE len(list_intersect(block, tokens)) >= least),
    labels AS (SELECT DISTINCT row, label, TRUE AS base FROM places UNION ALL SELECT DISTINCT row, label, FALSE FROM found)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n, 0) AS n_base, first_word, last_word,
           COALESCE((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM labels l WHERE l.row = read.row AND base), '') AS base_labels,
           COALESCE((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM labels l WHERE l.row = read.row), '') AS labels,
           CAST(GREATEST(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END, COALESCE((SELECT MAX(share) FROM found f WHERE f.row = read.row), 0.0)) AS DOUBLE) AS score
    FROM read LEFT JOIN base USING (row)"""


def importance_resampling(how: resampling.Resampling = resampling.Resampling()) -> str:
    """Weights, scores and ranks for features of one word; the checksum is worked out bit by bit, once for each word."""
    if how.runs != 1:
        raise ValueError("the SQL knows features of one word only")
    halved = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH checksums AS (
        SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: {halved})) AS tab),
    docs AS (SELECT doc_id, row_number() OVER () AS row_no, {words} AS words FROM documents),
    doc_words AS (SELECT row_no, word, COUNT(*) AS n FROM (SELECT row_no, unnest(words) AS word FROM docs) GROUP BY ALL),
    target_words AS (SELECT word, COUNT(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY ALL),
    spelled AS (
        SELECT word, list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS bytes
        FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words)),
    bucketed AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)
                     % {how.buckets} AS bucket
        FROM spelled, checksums),
    raw AS (SELECT bucket, SUM(n) AS s FROM doc_words JOIN bucketed USING (word) GROUP BY bucket),
    wanted AS (SELECT bucket, SUM(n) AS t FROM target_words JOIN bucketed USING (word) GROUP BY bucket),
    totals AS (
        SELECT (SELECT CAST(COALESCE(SUM(s), 0) + {how.buckets} AS DOUBLE) FROM raw) AS s_all,
               (SELECT CAST(COALESCE(SUM(t), 0) + {how.buckets} AS DOUBLE) FROM wanted) AS t_all),
    gained AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(COALESCE(t, 0) AS DOUBLE) + 1) * s_all / ((CAST(s AS DOUBLE) + 1) * t_all))) AS BIGINT) AS gain
        FROM raw LEFT JOIN wanted USING (bucket), totals),
    weighed AS (
        SELECT row_no, CAST(SUM(n * gain) AS BIGINT) AS weight
        FROM doc_words JOIN bucketed USING (word) JOIN gained USING (bucket) GROUP BY row_no),
    scored AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, COALESCE(weight, 0) AS weight,
               COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln(
                   (CAST('0x' || substr(sha256('{how.seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
        FROM docs LEFT JOIN weighed USING (row_no)),
    placed AS (
        SELECT *, CASE WHEN n_features >= {how.least_words} THEN row_number() OVER (
                   PARTITION BY n_features >= {how.least_words} ORDER BY score DESC, doc_id) END AS place,
               COUNT(*) FILTER (n_features >= {how.least_words}) OVER () AS drawable
        FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= {how.percent} * drawable // 100 THEN place END AS rank
    FROM placed
    """
