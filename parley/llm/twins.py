"""SQL twins that are built from parts."""

from __future__ import annotations

#: Steps that the twin of the manifest can climb: 16 ** 6 rows of a source, 16 ** 6 sources.
CLIMB = 6

# The CRC-32 of a text of ASCII signs; 3988292384 is its fixed polynomial.
CRC32 = """xor(list_reduce(list_transform(string_split({0}, ''), lambda c: unicode(c)::bigint), lambda crc, b:
            list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def manifest() -> str:
    """Levels of the trees, then every row's way up, siblings gathered and the claim folded."""
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""leaves AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
            CASE WHEN {CRC32.format('doc_id::varchar')} % 5 = 0 THEN {_leaf(small)} END AS claim FROM documents)""",
        """placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
            count(*) OVER (PARTITION BY source) AS size,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)""",
    ]

    def climb(name: str, start: str) -> str:
        steps.append(f"{name}0 AS ({start})")
        for k in range(CLIMB):
            steps.append(f"""{name}r{k} AS (SELECT tree, pos // 16 AS run, size, list(d ORDER BY pos) AS m
                FROM {name}{k} WHERE size > 1 GROUP BY ALL)""")
            steps.append(f"""{name}{k + 1} AS (SELECT tree, run AS pos, (size + 15) // 16 AS size,
                sha256(array_to_string(m, '')) AS d FROM {name}r{k})""")
        return " UNION ALL ".join(f"SELECT tree, d FROM {name}{k} WHERE size = 1" for k in range(CLIMB + 1))

    subroots = climb("n", "SELECT tree, pos, size, leaf AS d FROM placed")
    steps.append(f"subroots AS ({subroots})")
    root = climb("t", "SELECT 0 AS tree, tree AS pos, count(*) OVER () AS size, d FROM subroots")
    steps.append(f"roots AS ({root})")
    steps.append("w0 AS (SELECT *, coalesce(claim, leaf) AS reached, '' AS seen FROM placed)")
    k = 0
    for name, tree, pos in (("n", "w.tree", "w.pos"), ("t", "0", "w.tree")):
        for level in range(CLIMB):
            here = f"({pos} // {16 ** level})"
            steps.append(f"""w{k + 1} AS (SELECT w.* EXCLUDE (reached, seen),
                CASE WHEN m IS NULL THEN reached ELSE sha256(array_to_string(m[1:{here} % 16], '') || reached
                    || array_to_string(m[{here} % 16 + 2:], '')) END AS reached,
                CASE WHEN m IS NULL THEN seen ELSE seen || array_to_string(m[1:{here} % 16], '')
                    || array_to_string(m[{here} % 16 + 2:], '') END AS seen
                FROM w{k} w LEFT JOIN {name}r{level} r ON r.tree = {tree} AND r.run = {here} // 16)""")
            k += 1
    return f"""WITH {', '.join(steps)}
        SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(seen) AS proof_sha256,
               reached AS folded_root, reached = r.d AS verified
        FROM w{k} JOIN subroots s USING (tree), roots r"""


def spans(rules, base: int) -> str:
    """Matches wrapped in a private sign; running lengths of the pieces between them give their places."""
    mark = "chr(57344)"
    parts = []
    for no, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""SELECT rid, {no} AS no, '{rule.kind}' AS kind, n, length(piece) AS size, {rule.least} AS least,
            sum(length(piece)) OVER (PARTITION BY rid ORDER BY n) AS till
            FROM (SELECT rid, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n FROM (
                SELECT rid, string_split(regexp_replace(t, '{pattern}',
                    {mark} || '\\1' || {mark} || '\\2' || {mark}, 'g'), {mark}) AS pieces
                FROM texts WHERE regexp_matches(t, '{pattern}')))""")
    counts = ", ".join(
        f"count(f.rid) FILTER (f.no = {no})::bigint AS n_{rules[no].kind}" for no in range(base)
    )
    return f"""WITH texts AS MATERIALIZED (
            SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS rid, replace(coalesce(text, ''), {mark}, chr(57345)) AS t FROM documents),
        pieces AS ({' UNION ALL '.join(parts)}),
        found AS (
            SELECT v.rid, v.no, v.kind || ':' || (b.till - b.size)::bigint || ':' || v.till::bigint AS span,
                   (b.till - b.size)::bigint AS start
            FROM pieces v JOIN pieces b ON b.rid = v.rid AND b.no = v.no AND b.n = v.n - 1
            WHERE v.n % 3 = 0 AND v.size >= v.least)
        SELECT any_value(doc_id) AS doc_id, {counts},
               sha256(coalesce(string_agg(span, ',' ORDER BY start, no) FILTER (no < {base}), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY start, no), '') AS spans
        FROM texts LEFT JOIN found f ON f.rid = texts.rid GROUP BY texts.rid"""


def conversations() -> str:
    """Costs and letters from the last row backwards for the four states, then the rows once more for the text."""
    other = {"e": "u", "s": "u", "u": "a", "a": "u"}
    keeps = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def plus(cost: str, letter: str, state: str) -> str:
        return f"{{'c': {cost} + {state}.c, 'l': '{letter}' || {state}.l}}"

    rows, steps = [], []
    for p, o in other.items():
        kept = " ".join(
            f"WHEN fault < 2 AND ini = '{i}' THEN {plus('5 * fault', 'K', f'v.{q}')}" for i, q in keeps[p].items()
        )
        rows.append(f"""least({plus('2', 'D', f'v.{p}')}, CASE {kept} ELSE {{'c': 1000000000::bigint, 'l': ''}} END,
            CASE WHEN fault < 2 THEN {plus('1 + 5 * fault', 'R', f'v.{o}')} ELSE {{'c': 1000000000::bigint, 'l': ''}} END) AS {p}""")
        steps.append(f"least({p}, {plus('5', 'I', o)}, {plus('10', 'II', other[o])}) AS {p}")
    return f"""WITH RECURSIVE plain AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {CRC32.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 AS harm
            FROM conversations),
        ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS cid FROM (SELECT DISTINCT conv_id FROM plain)),
        harmed AS (
            SELECT cid, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                   CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM plain JOIN ids ON ids.conv_id IS NOT DISTINCT FROM plain.conv_id,
                 unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) WHERE harm <> 0),
        numbered AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM harmed),
        marked AS MATERIALIZED (
            SELECT *, role[1] AS ini,
                CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 3
                     WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 2
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault,
                lag(role[1]) OVER (PARTITION BY cid ORDER BY i) AS last FROM numbered),
        back AS (
            SELECT ids.cid, count(m.cid) + 1 AS i, {{'c': 0::bigint, 'l': ''}} AS e, {{'c': 10::bigint, 'l': 'II'}} AS s,
                   {{'c': 5::bigint, 'l': 'I'}} AS u, {{'c': 0::bigint, 'l': ''}} AS a
            FROM ids LEFT JOIN marked m ON m.cid = ids.cid GROUP BY ids.cid
            UNION ALL
            SELECT cid, i, {', '.join(steps)} FROM (
                SELECT m.cid, m.i, {', '.join(rows)} FROM back v JOIN marked m ON m.cid = v.cid AND m.i = v.i - 1)),
        best AS (SELECT cid, e.c AS cost, e.l AS audit FROM back WHERE i = 1),
        letters AS (
            SELECT cid, j, l, count(*) FILTER (l <> 'I') OVER upto AS i, count(*) FILTER (l <> 'D') OVER upto AS o
            FROM (SELECT cid, unnest(string_split(audit, '')) AS l, generate_subscripts(string_split(audit, ''), 1) AS j
                  FROM best WHERE audit <> '')
            WINDOW upto AS (PARTITION BY cid ORDER BY j)),
        lines AS (
            SELECT b.cid, b.j, b.l, b.o, m.role, m.text, m.ini,
                   bool_or(b.l = 'K' AND b.o = 1 AND m.ini = 's') OVER (PARTITION BY b.cid) AS led
            FROM letters b LEFT JOIN marked m ON m.cid = b.cid AND m.i = b.i AND b.l <> 'I' WHERE b.l <> 'D'),
        texts AS (
            SELECT cid, string_agg(CASE WHEN l = 'K' THEN role WHEN (o + led::int) % 2 = 1 THEN 'user' ELSE 'assistant' END
                   || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS whole FROM lines GROUP BY cid),
        counts AS (
            SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 1) AS truncated,
                   count(*) FILTER (i > 1 AND last || ini NOT IN ('su', 'ua', 'au')) AS illegal
            FROM marked GROUP BY cid)
        SELECT conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
               sha256(coalesce(whole, '')) AS repaired_sha256
        FROM ids JOIN best USING (cid) LEFT JOIN texts USING (cid) LEFT JOIN counts USING (cid)"""
