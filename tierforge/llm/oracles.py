"""DuckDB SQL for the queries that SQL can express on the whole tables.

Checksums (CRC-32) and the hashes that deal out copies have no function there, and fitted models
and parsed pages no expression: those queries are tested against plain Python instead.
"""

from __future__ import annotations

from tierforge.llm import personal
from tierforge.llm.host_rules import RATES, RULES, HostRules
from tierforge.llm.secrets import ALLOWED, BASE_KINDS, CLASSES, IDENTIFIER

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_TEXT = "coalesce(text, '')"
_LOWER = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _any_case(letters: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in letters)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + (
    f"|{_any_case('api')}_?{_any_case('key')}"
)
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SHAPES = {
    "assign": (_ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 12"),
    "access": ("AKIA[A-Z0-9]+", "length(m) >= 18"),
    "hex": ("[0-9a-f]+", "length(m) >= 16"),
}


def _places(source: str, pattern: str) -> str:
    """``doc_id, m, s``: the leftmost matches of a pattern and where they start."""
    return f"""
      SELECT doc_id, ms[k] AS m,
             list_sum(list_transform(gs[1:k], lambda g: length(g)))
             + coalesce(list_sum(list_transform(ms[1:k - 1], lambda g: length(g))), 0) AS s
      FROM (SELECT doc_id, gs, ms, unnest(range(1, len(ms) + 1)) AS k FROM (
        SELECT doc_id, regexp_extract_all(t, '(?s)(.*?)({pattern})', 1) AS gs,
               regexp_extract_all(t, '(?s)(.*?)({pattern})', 2) AS ms FROM {source}))"""


def _secrets() -> str:
    parts, names = [f"t AS (SELECT doc_id, {_TEXT} AS t FROM documents)"], []
    for rank, (kind, (pattern, holds)) in enumerate(_SHAPES.items()):
        parts.append(
            f"{kind}_s AS (SELECT doc_id, s::BIGINT AS s, {rank} AS r, '{kind}' AS kind,"
            f" (s + length(m))::BIGINT AS e FROM ({_places('t', pattern)}) WHERE {holds})"
        )
        names.append(f"SELECT * FROM {kind}_s")
    parts.append("base AS (" + " UNION ALL ".join(names) + ")")
    found = []
    for rank, cls in enumerate(CLASSES, len(BASE_KINDS)):
        folded = "lower(m)" if cls.alphabet.lower() == cls.alphabet else "m"
        needs = "".join(f" AND regexp_matches(m, '{need}')" for need in cls.needs)
        w, name = cls.window, cls.kind
        before = "coalesce(list_sum(list_transform({}[1:k - 1], lambda g: length(g))), 0)"
        parts.append(f"""{name}_c AS (SELECT doc_id, {folded} AS m, s FROM (
          SELECT doc_id, ps[k] AS m, s + {before.format("ps")} + {before.format("xs")} AS s
          FROM (SELECT doc_id, s, ps, xs, unnest(range(1, len(ps) + 1)) AS k FROM (
            SELECT doc_id, s, string_split_regex(m, '{ALLOWED}') AS ps,
                   regexp_extract_all(m, '{ALLOWED}') AS xs
            FROM ({_places("t", f"{cls.members}{{{w},}}")})
            WHERE NOT regexp_matches(m, '{IDENTIFIER}'))))
          WHERE length(m) >= {w}{needs})""")
        parts.append(f"""{name}_w AS (SELECT doc_id, s, i,
            coalesce(i > lag(i) OVER (PARTITION BY doc_id, s ORDER BY i) + {w}, true) AS new
          FROM (SELECT doc_id, s, i, substr(m, i + 1, {w}) AS x FROM (
            SELECT doc_id, m, s, unnest(range(0, length(m) - {w} + 1)) AS i FROM {name}_c))
          WHERE list_aggregate(string_split(x, ''), 'entropy') >= {cls.threshold})""")
        parts.append(f"""{name}_s AS (SELECT doc_id, (s + min(i))::BIGINT AS s, {rank} AS r,
            '{name}' AS kind, (s + max(i) + {w})::BIGINT AS e
          FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id, s ORDER BY i) AS island
                FROM {name}_w) GROUP BY doc_id, s, island)""")
        found.append(f"SELECT * FROM {name}_s")
    parts.append(
        "more AS (SELECT * FROM (" + " UNION ALL ".join(found) + """) x WHERE NOT EXISTS (
          SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.s <= x.s AND x.e <= b.e))"""
    )
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e)"
    counts = ", ".join(f"coalesce(b.n_{k}, 0)::BIGINT AS n_{k}" for k in BASE_KINDS)
    inner = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""WITH {", ".join(parts)},
      b AS (SELECT doc_id, {inner}, {listed} AS spans FROM base GROUP BY doc_id),
      a AS (SELECT doc_id, count(*) FILTER (r >= {len(BASE_KINDS)}) AS n, {listed} AS spans
            FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY doc_id)
    SELECT t.doc_id, {counts}, sha256(coalesce(b.spans, '')) AS base_sha256,
           coalesce(a.spans, '') AS spans, coalesce(a.n, 0)::BIGINT AS n_entropy
    FROM t LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""


def _jaccard(size: int, percent: int) -> str:
    return f"""WITH RECURSIVE
    w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, list_aggregate(w[i + 1:i + n], 'string_agg', ' ') AS g
          FROM (SELECT doc_id, w, least({size}, len(w)) AS n,
                       unnest(range(0, len(w) - least({size}, len(w)) + 1)) AS i
                FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
          WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * c >= {percent} * (x.n + y.n - c)),
    r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
    SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
           coalesce((SELECT min(c) FROM r WHERE r.doc_id = w.doc_id), w.doc_id) AS component_id,
           (SELECT count(*) FROM l WHERE l.a = w.doc_id)::BIGINT AS n_links
    FROM w LEFT JOIN n USING (doc_id)"""


def _substrings(window: int) -> str:
    return f"""WITH w AS (SELECT doc_id, {_WORDS.format(text=_TEXT)} AS w FROM documents),
    x AS (SELECT doc_id, i, list_aggregate(w[i + 1:i + {window}], 'string_agg', ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(0, len(w) - {window - 1})) AS i FROM w)),
    f AS (SELECT g, min(doc_id) AS first FROM x GROUP BY g),
    c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS k
          FROM x JOIN f USING (g) WHERE first < doc_id),
    u AS (SELECT doc_id, w[k + 1] AS word, k
          FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS k FROM w)),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t
             FROM u ANTI JOIN c USING (doc_id, k) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words,
           (SELECT count(*) FROM c WHERE c.doc_id = w.doc_id)::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)"""


def _host_rules(rules: HostRules) -> str:
    failed = {
        "too_short": f"n_words < {rules.min_words}",
        "repetitive": f"100 * n_repeat_words > {rules.max_repeat_pct} * n_words",
        "symbols": f"100 * n_symbols > {rules.max_symbol_pct} * word_chars",
        "dup_lines": f"100 * n_dup_lines > {rules.max_dup_line_pct} * n_lines",
    }
    failed["any_rule"] = " OR ".join(failed[r] for r in RULES)
    sums, priors = [], []
    for r in RATES:
        sums.append(f"sum(({failed[r]})::INT) AS {r}")
        mean = f"(f_{r} / n)"
        spread = f"((ff_{r} - n * {mean} * {mean} - (h - 1) * {mean} * (1 - {mean})) / (n - nn / n))"
        priors.append(f"""CASE WHEN h < 2 OR f_{r} <= 0 OR f_{r} >= n THEN greatest(n, 1.0)
          ELSE least(greatest(CASE WHEN {spread} > 0 THEN {mean} * (1 - {mean}) / {spread} - 1
                              ELSE n END, 1.0), n) END AS k_{r}, f_{r} / n AS m_{r}""")
    x, k = "((any_rule + m_any_rule * k_any_rule) / (docs + k_any_rule))", "k_any_rule"
    unsure = f"sqrt({x} * (1 - {x}) / (docs + {k} + 1))"
    spread = f"sqrt(m_any_rule * (1 - m_any_rule) / ({k} + 1))"
    condemned = (
        f"{x} - {rules.sure_deviations} * {unsure} > {rules.max_host_rate}"
        f" AND {x} > m_any_rule + {rules.prior_deviations} * {spread}"
    )
    totals = ", ".join(f"sum({r})::DOUBLE AS f_{r}, sum({r} * {r} / docs) AS ff_{r}" for r in RATES)
    return f"""WITH w AS (SELECT doc_id, source, {_TEXT} AS t, {_WORDS.format(text=_TEXT)} AS w
      FROM documents),
    g AS (SELECT doc_id, i, w[i + 1:i + 3] AS g
          FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS i FROM w)),
    again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g)
              WHERE c > 1),
    rep AS (SELECT doc_id, count(DISTINCT k) AS n
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d
              FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w)
              WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words,
                 length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                 coalesce(lines.n - lines.d, 0)::BIGINT AS n_dup_lines,
                 coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
          FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
    h AS (SELECT source, count(*) AS docs, {", ".join(sums)} FROM m GROUP BY source),
    a AS (SELECT count(*) AS h, sum(docs)::DOUBLE AS n, sum(docs * docs)::DOUBLE AS nn, {totals}
          FROM h),
    k AS (SELECT {", ".join(priors)} FROM a),
    v AS (SELECT source, {condemned} AS condemned FROM h, k)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           {failed["too_short"]} OR {failed["repetitive"]} AS base_failed,
           NOT ({failed["too_short"]} OR {failed["repetitive"]}) AND NOT condemned AS kept
    FROM m JOIN v ON m.source IS NOT DISTINCT FROM v.source"""


def _benchmark(size: int) -> str:
    words = (
        f"list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),"
        " lambda w: w <> '')"
    )
    joined = "list_aggregate(w[i + 1:i + n], 'string_agg', ' ')"
    return f"""WITH b AS (SELECT item_id, {words} AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, n, {joined} AS g
           FROM (SELECT item_id, w, least(len(w), {size}) AS n,
                        unnest(range(0, len(w) - least(len(w), {size}) + 1)) AS i
                 FROM b WHERE len(w) > 0)),
    d AS (SELECT doc_id, {words} AS w FROM documents),
    dw AS (SELECT doc_id, n, i, {joined} AS g
           FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i
                 FROM d, (SELECT DISTINCT n FROM bw))),
    hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
    words AS (SELECT doc_id, count(DISTINCT k) AS n
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
           coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(words.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _clusters(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Every round compares every vector with every centroid."""
    apart = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    nearest = (
        "SELECT p.r, p.vec_id, p.x, arg_min(c.c, {d} * {k} + c.c) AS c, min({d})::BIGINT AS d"
        " FROM p, c{n} c GROUP BY p.r, p.vec_id, p.x"
    )
    parts = [
        f"""p AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
              list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
            FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding,
              lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (
              SELECT sha256('{seed}:' || vec_id) AS h, x FROM p ORDER BY h, x LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        distance = apart.format(a="p.x", b="c.x")
        parts.append(f"a{n} AS MATERIALIZED ({nearest.format(d=distance, k=k, n=n)})")
        if n < rounds:
            # Division that rounds down.
            parts.append(f"""c{n + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x
              FROM c{n} c LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
                FROM (SELECT c, i, sum(v)::BIGINT AS s, count(*) AS n
                      FROM (SELECT c, unnest(x) AS v, unnest(range({dims})) AS i FROM a{n})
                      GROUP BY c, i) GROUP BY c) m USING (c))""")
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, c::INTEGER AS cluster, d AS distance,
           (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(z.x, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} z USING (c)"""


def _personal() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i:"
        " CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN c::INT * 2 - 9"
        " ELSE c::INT * 2 END)) % 10 = 0"
    )
    signs = "replace(x, ' ', '')"
    modulo = (
        f"list_reduce(list_prepend(0, list_transform(string_split({signs}[5:] || {signs}[:4], ''),"
        " lambda c: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1)),"
        " lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97) = 1"
    )
    cues = "|".join(s for cue in personal.CUES for s in personal.spellings(cue))
    front, ibans = "(?:^|[^A-Za-z0-9])", "|".join(personal.spellings("iban"))
    iban = f"{front}(?:{ibans}){personal.JOINT}({personal.IBAN})"
    account = f"{front}(?:{cues}){personal.JOINT}({personal.ACCOUNT})"
    # Kind, pattern, start and text of the span within match ``m`` at ``s``, what must hold.
    kinds = [
        ("email", rf"[A-Za-z0-9._%+-]+@{personal.DOMAIN}", "m", "true"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "m",
         "len(list_filter(string_split(m, '.'), lambda n: length(ltrim(n, '0')) > 3"
         " OR coalesce(try_cast(n AS INT), 256) > 255)) = 0"),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", "m", f"length({digits}) BETWEEN 16 AND 19 AND {luhn}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "m", f"length({digits}) BETWEEN 8 AND 15"),
        ("link", f"[A-Za-z]+{personal.LINK}", f"rtrim(m, '{personal.OPEN_END}')",
         "lower(split_part(m, '://', 1)) IN (" + ", ".join(f"'{s}'" for s in personal.SCHEMES) + ")"),
        ("iban", iban, f"regexp_extract(m, '{iban}', 1)", modulo),
        ("account", account, f"regexp_extract(m, '{account}', 1)",
         "length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 6 AND 34"),
    ]
    parts = [f"t AS (SELECT doc_id, {_TEXT} AS t FROM documents)"]
    for rank, (kind, pattern, part, holds) in enumerate(kinds):
        start = "s + length(m) - length(x)" if kind in ("iban", "account") else "s"
        parts.append(f"""{kind}_s AS (SELECT doc_id, ({start})::BIGINT AS s, {rank} AS r,
          '{kind}' AS kind, ({start} + length(x))::BIGINT AS e
          FROM (SELECT doc_id, m, s, {part} AS x FROM ({_places("t", pattern)})) WHERE {holds})""")
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY r, s)"
    counts = ", ".join(f"coalesce(n_{k[0]}, 0)::BIGINT AS n_{k[0]}" for k in kinds)
    inner = ", ".join(f"count(*) FILTER (kind = '{k[0]}') AS n_{k[0]}" for k in kinds)
    every = " UNION ALL ".join(f"SELECT * FROM {k[0]}_s" for k in kinds)
    return f"""WITH {", ".join(parts)},
      f AS (SELECT doc_id, {inner}, {listed} AS spans, {listed}
              FILTER (r < {len(personal.BASE_KINDS)}) AS base FROM ({every}) GROUP BY doc_id)
    SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans FROM t LEFT JOIN f USING (doc_id)"""


def _ranking(k: int = 50) -> str:
    words = (
        f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    )
    return f"""WITH i AS (SELECT DISTINCT item_id, unnest({words}) AS t FROM benchmark),
    d AS (SELECT doc_id, unnest({words}) AS t FROM documents),
    n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
    g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM i) GROUP BY doc_id, t),
    w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
          FROM tf, g GROUP BY t, docs),
    s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf)
                 // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
          FROM i JOIN tf USING (t) JOIN w USING (t) JOIN n USING (doc_id), g
          GROUP BY item_id, doc_id),
    r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                 AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {k}"""


ORACLES: dict[str, str] = {
    "op1_secret_spans": _secrets(),
    "op2_ngram_jaccard": _jaccard(3, 90),
    "op7_fm_index": _substrings(13),
    "op8_host_rules": _host_rules(HostRules()),
    "op9_benchmark_windows": _benchmark(10),
    "op11_simplex_clusters": _clusters(),
    "op12_anchored_personal_data": _personal(),
    "op13_best_positions": _ranking(),
}
