"""What every query must return, as SQL over the given tables.

For the mail queries the expected columns are stated from the ids that the
mails are made of, not by parsing mails, so they share nothing with the parser.
"""

from __future__ import annotations

# One row per mail made by ``corpus.mail_archive``.
_MAILS = """mails AS (
  SELECT 'list-' || role AS list, conv_id * 100 + turn AS article_no, 'c' AS src,
         conv_id * 8 + turn AS k, text FROM conversations
  UNION ALL
  SELECT source, doc_id, 'd', doc_id, text FROM documents)"""

_BROKEN = "k % 13 = 5"
_STRAY = "k % 11 = 3"

_SENT = """CASE WHEN k % 17 IN (4, 9) THEN NULL
  ELSE TIMESTAMP '2019-07-01 00:00:00' + to_seconds((k * 790001) % 94608000) END"""

_TRAILERS = """CASE k % 5
  WHEN 1 THEN chr(10) || chr(10) || 'Reviewed-by: Rev ' || (k % 50) || ' <rev' || (k % 50) || '@lab.example>'
  WHEN 2 THEN chr(10) || chr(10) || 'reviewed-by:   Rev B <revb@lab.example>  # ok' || chr(10)
           || 'Tested-by: T ' || (k % 3) || ' <t@lab.example>'
  WHEN 3 THEN chr(10) || chr(10) || 'Reviewed-and-tested-by: RT <rt@lab.example>' || chr(10)
           || ' Reviewed-by: In <in@lab.example>' || chr(10) || 'Reported-by: nobody@lab.example'
  WHEN 4 THEN chr(10) || chr(10) || 'Acked-by:' || chr(9) || ' Ann  < ann@lab.example >' || chr(10)
           || 'Tested-by: U <u@lab.example>'
  ELSE '' END"""

# The body without the line end that closes its last line.
_PATCHED = """CASE k % 6
  WHEN 1 THEN chr(10) || code1
  WHEN 2 THEN chr(10) || 'prose' || chr(10) || code1
  WHEN 3 THEN chr(10) || code1 || chr(10) || 'between' || chr(10) || code2
  WHEN 4 THEN chr(10) || code1
  WHEN 5 THEN chr(10) || code1
  ELSE '' END"""

_CODE1 = """CASE k % 6
  WHEN 1 THEN '---' || chr(10) || ' f' || k || '.c | 2 +-' || chr(10) || chr(10) || 'diff --git a/f' || k
           || '.c b/f' || k || '.c' || chr(10) || '+x' || chr(10) || '--' || chr(10) || '2.40.1'
  WHEN 2 THEN 'diff --git a/g' || k || ' b/g' || k || chr(10) || '-y' || chr(10) || '-- ' || chr(10) || '2.30'
  WHEN 3 THEN '---' || chr(10) || ' a' || k || chr(10) || '-- ' || chr(10) || '2.1'
  WHEN 4 THEN '---' || chr(10) || ' q' || k || chr(10) || '-- =' || chr(10) || chr(10) || '2.26.2'
  WHEN 5 THEN '---' || chr(10) || ' u' || k || chr(10) || '- item' || chr(10) || 'tail line'
  END"""

_CODE2 = """CASE WHEN k % 6 = 3
  THEN '---' || chr(10) || ' b' || k || chr(10) || '--' || chr(10) || '2.2' END"""

_SUBJECT = """CASE k % 8 WHEN 2 THEN 'part ' || k || ' continued end' WHEN 4 THEN 'Topic ' || k
  ELSE 'Re: topic: ' || k END"""

# Trailers as expected: up to two per mail.
_PEOPLE = """
  SELECT list, article_no, k, 0 AS pos,
    CASE k % 5 WHEN 1 THEN 'Reviewed-by' WHEN 2 THEN 'reviewed-by'
      WHEN 3 THEN 'Reviewed-and-tested-by' WHEN 4 THEN 'Acked-by' END AS attribution,
    CASE k % 5 WHEN 1 THEN 'Rev ' || (k % 50) || ' <rev' || (k % 50) || '@lab.example>'
      WHEN 2 THEN 'Rev B <revb@lab.example>' WHEN 3 THEN 'RT <rt@lab.example>'
      WHEN 4 THEN 'Ann <ann@lab.example>' END AS identification
  FROM alive WHERE k % 5 <> 0
  UNION ALL
  SELECT list, article_no, k, 1, 'Tested-by',
    CASE k % 5 WHEN 2 THEN 'T ' || (k % 3) || ' <t@lab.example>' ELSE 'U <u@lab.example>' END
  FROM alive WHERE k % 5 IN (2, 4)"""

_ALIVE = f"""{_MAILS},
coded AS (SELECT *, {_CODE1} AS code1, {_CODE2} AS code2 FROM mails),
alive AS (
  SELECT *, {_SENT} AS sent, text || {_TRAILERS} || {_PATCHED} AS body,
    CASE WHEN k % 5 IN (1, 2) THEN 1 ELSE 0 END AS reviewed,
    CASE WHEN k % 5 IN (2, 4) THEN 1 ELSE 0 END AS tested,
    'Author ' || (k % 97) || ' <a' || (k % 97) || '@mail.example>' AS sender,
    CASE WHEN k % 8 = 5 THEN ''
      WHEN k % 19 = 7 AND k >= 40 THEN '<' || (k - 40) || '.' || src || '@mail.example>'
      ELSE '<' || k || '.' || src || '@mail.example>' END AS message_id
  FROM coded WHERE NOT ({_BROKEN}) AND NOT ({_STRAY})),
people AS ({_PEOPLE})"""

# The raw mails, written out line by line; a broken one has one more byte, FF.
_DATE_LINE = """'Date: ' || CASE k % 17 WHEN 4 THEN 'n/a' WHEN 9 THEN 'yesterday at noon' ELSE CASE k % 6
    WHEN 0 THEN strftime(made_at, '%a, %d %b %Y %H:%M:%S +0200')
    WHEN 1 THEN strftime(made_at, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 2 THEN strftime(made_at, '%a %b %-d %H:%M:%S %Y')
    WHEN 3 THEN strftime(made_at, '%a, %d %b %Y %H.%M.%S')
    WHEN 4 THEN strftime(made_at, '%-m/%-d/%Y %-I:%M:%S %p')
    ELSE strftime(made_at, '%a, %d %b %Y %H:%M:%S -0700 PDT') END END"""

_HEADER = f"""concat_ws(chr(10),
    'From: Author ' || (k % 97) || ' <a' || (k % 97) || '@mail.example>',
    CASE k % 8 WHEN 5 THEN NULL
      WHEN 3 THEN 'To: x' || k || '@one.example' || chr(10) || 'To: y' || k || '@two.example, z@two.example'
      ELSE 'To: p' || (k % 7) || '@one.example, q' || (k % 5) || '@two.example' END,
    CASE WHEN k % 8 = 6 THEN 'Cc: c1@x.example,c2@x.example,  c3@x.example' END,
    CASE k % 8 WHEN 2 THEN 'Subject: part ' || k || chr(10) || chr(9) || 'continued  ' || chr(10) || '  end'
      WHEN 4 THEN 'SUBJECT : Topic ' || k || ' ' ELSE 'Subject: Re: topic: ' || k END,
    {_DATE_LINE},
    CASE WHEN k % 8 = 3 THEN 'Date: Mon, 01 Jan 1990 00:00:00 +0000' END,
    CASE WHEN k % 8 = 5 THEN NULL
      WHEN k % 19 = 7 AND k >= 40 THEN 'Message-ID: <' || (k - 40) || '.' || src || '@mail.example>'
      ELSE 'Message-ID: <' || k || '.' || src || '@mail.example>' END,
    CASE WHEN k % 8 <> 5 AND k % 3 = 1 THEN 'In-Reply-To: <' || (k - 1) || '.' || src || '@mail.example>' END,
    CASE WHEN k % 8 = 5 THEN NULL
      WHEN k % 8 = 2 THEN 'References: <r1.' || k || '@x.example>' || chr(10) || ' <r2.' || k || '@x.example>'
      WHEN k % 3 = 1 THEN 'References: <a.' || k || '@x.example>  <b.' || k || '@x.example>' END,
    CASE WHEN k % 8 = 7 THEN 'X-Mailing-List: box' || (k % 5) || '@lists.example' END)"""

_PATCH_LINES = """CASE k % 6
    WHEN 1 THEN chr(10) || code1
    WHEN 2 THEN chr(10) || 'prose' || chr(10) || 'diff --git a/g' || k || ' b/g' || k || chr(10) || '-y' || chr(10)
      || '-- ' || chr(10) || '2.30' || chr(10)
    WHEN 3 THEN chr(10) || code1 || chr(10) || 'between' || chr(10) || code2 || chr(10)
    WHEN 4 THEN chr(10) || code1 || chr(10)
    WHEN 5 THEN chr(10) || code1
    ELSE '' END"""

_RAW = f"""{_MAILS},
dated AS (SELECT *, {_CODE1} AS code1, {_CODE2} AS code2,
  TIMESTAMP '2019-07-01 00:00:00' + to_seconds((k * 790001) % 94608000) AS made_at FROM mails),
sentences AS (SELECT *, {_HEADER} || chr(10) || chr(10) || text || {_TRAILERS} || {_PATCH_LINES} AS message FROM dated),
raw AS (SELECT *, CASE WHEN {_STRAY} THEN ' stray continuation' || chr(10) ELSE '' END
    || CASE WHEN k % 8 = 1 THEN replace(message, chr(10), chr(13) || chr(10)) ELSE message END AS whole
  FROM sentences),
stored AS (SELECT *, CASE WHEN {_BROKEN} THEN encode(whole) || '\\xFF'::BLOB ELSE encode(whole) END AS content FROM raw)"""

_TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def _alive(select: str) -> str:
    return f"WITH {_ALIVE} {select}"


def _mails(select: str) -> str:
    return f"WITH {_MAILS} {select}"


def _raw(select: str) -> str:
    return f"WITH {_RAW} {select}"


def _keyed(value: str) -> str:
    """HMAC-SHA256 of a text under the key of the query."""
    inner, outer = (
        bytes(b ^ pad for b in b"key of the archive".ljust(64, b"\0")).hex() for pad in (0x36, 0x5C)
    )
    inside = f"from_hex(sha256(from_hex('{inner}') || encode({value})))"
    return f"sha256(from_hex('{outer}') || {inside})"


def _stage(stage: str, where: str, name: str = "list") -> str:
    """Stored mails per list and outcome, of those that ``where`` names."""
    return f"""SELECT {name} AS list,
      CASE WHEN {_BROKEN} OR {_STRAY} THEN 'errors' ELSE 'parsed' END AS outcome,
      count(*) AS mails, '{stage}' AS stage FROM mails WHERE {where} GROUP BY ALL"""


_UNNAMED = "CASE WHEN list = 'list-system' THEN '' ELSE list END"


def _receivers(name: str = "items") -> str:
    return f"""CASE WHEN k % 8 = 5 THEN ['']
      WHEN k % 8 = 3 THEN ['x' || k || '@one.example', 'y' || k || '@two.example, z@two.example']
      ELSE ['p' || (k % 7) || '@one.example', ' q' || (k % 5) || '@two.example'] END AS {name}"""


_COPIES = """CASE WHEN k % 8 = 6 THEN ['c1@x.example', 'c2@x.example', '  c3@x.example']
      ELSE [''] END"""


def _unfold(inner: str, columns: str, item: str = "item") -> str:
    """One row per item of ``items``, with its position from 0."""
    return f"""SELECT {columns}, CAST(unnest(range(len(items))) AS INTEGER) AS pos, unnest(items) AS {item}
      FROM ({inner})"""


def _rolling(source: str, lists: str, window: int, step: int, values: dict[str, str]) -> str:
    """A sliding window by a plain range join, as a check on the one by runs.

    ``source`` has columns ts, grp and the values.
    """
    sums = ", ".join(f"CAST(coalesce(sum({v}), 0) AS BIGINT) AS {n}" for n, v in values.items())
    return f"""
src AS ({source}),
span AS (SELECT min(ts) + INTERVAL {window} DAY AS lo, max(ts) AS hi FROM src WHERE ts IS NOT NULL),
grid AS (
  SELECT s.t, g.grp FROM (SELECT unnest(generate_series(lo, hi, INTERVAL {step} DAY)) AS t FROM span) s,
    ({lists}) g, span WHERE s.t < span.hi),
rolled AS (
  SELECT strftime(t, {_TIME}) AS sample_ts, grid.grp AS grp, {sums}
  FROM grid LEFT JOIN src ON src.grp = grid.grp
    AND src.ts >= t - INTERVAL {window} DAY AND src.ts <= t + INTERVAL 1 DAY
  GROUP BY t, grid.grp)"""


def _nearest(table: str, column: str, q: float) -> str:
    return f"""(SELECT v FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) - 1 AS r,
      count(*) OVER () AS n FROM {table} WHERE {column} IS NOT NULL)
      WHERE r = CAST(floor({q} * (n - 1) + 0.5) AS BIGINT))"""


def _profile_row(table: str, column: str, kind: str) -> str:
    """One row of a profile; ``kind`` is number, text, time or list."""
    quoted, none = f'"{column}"', "CAST(NULL AS VARCHAR)"
    mean = std = "CAST(NULL AS DOUBLE)"
    low, high, quartiles = none, none, [none] * 3
    if kind == "number":
        mean, std = f"round(avg({quoted}), 6)", f"round(stddev_samp({quoted}), 6)"
    if kind in ("number", "time"):
        quartiles = [f"CAST({_nearest(table, quoted, q)} AS VARCHAR)" for q in (0.25, 0.5, 0.75)]
    if kind != "list":
        low, high = f"CAST(min({quoted}) AS VARCHAR)", f"CAST(max({quoted}) AS VARCHAR)"
    return f"""SELECT '{column}' AS "column", count({quoted}) AS count,
      count(*) - count({quoted}) AS nulls, {mean} AS mean, {std} AS std, {low} AS lowest,
      {quartiles[0]} AS q25, {quartiles[1]} AS q50, {quartiles[2]} AS q75, {high} AS highest
      FROM {table}"""


_ROLLING_VALUES = {"reviewed": "reviewed", "tested": "tested"}
_ACTIVITY = """SELECT sample_ts, grp AS list, reviewed, tested, reviewed + tested AS "any" FROM rolled"""

_GAPS = """
  SELECT list, article_no + 1 AS first_missing, nxt - 1 AS last_missing, nxt - article_no - 1 AS missing
  FROM (SELECT list, article_no, lead(article_no) OVER (PARTITION BY list ORDER BY article_no) AS nxt
        FROM (SELECT DISTINCT list, article_no FROM {source}))
  WHERE nxt > article_no + 1"""

_SIZES = "SELECT source, count(text) AS mails FROM documents GROUP BY source"

_AUTHORS = """SELECT c_name, o_orderpriority AS list, count(*) AS mails
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "review_counts": _alive("""SELECT list, count(*) AS mails, CAST(sum(reviewed) AS BIGINT) AS reviewed,
      CAST(sum(tested) AS BIGINT) AS tested, CAST(sum(reviewed + tested) AS BIGINT) AS "any" FROM alive GROUP BY list"""),
    "raw_mails": _mails("""SELECT list, count(*) AS mails, min(article_no) AS lowest,
      max(article_no) AS highest FROM mails GROUP BY list"""),
    "split_messages": _alive("""SELECT list, article_no, length(body) AS body_chars,
      md5(body) AS body_md5 FROM alive"""),
    "headers": _alive(f"""SELECT list, article_no, sender AS "from", {_SUBJECT} AS subject,
      message_id,
      CASE WHEN k % 8 <> 5 AND k % 3 = 1 THEN '<' || (k - 1) || '.' || src || '@mail.example>'
        ELSE '' END AS in_reply_to,
      CASE WHEN k % 8 = 7 THEN 'box' || (k % 5) || '@lists.example' ELSE '' END AS x_mailing_list
      FROM alive"""),
    "addresses": _alive(
        _unfold(
            f"""SELECT list, article_no, 'to' AS field, {_receivers()} FROM alive
            UNION ALL SELECT list, article_no, 'cc', {_COPIES} FROM alive""",
            "list, article_no, field",
        )
    ),
    "references": _alive(
        _unfold(
            """SELECT list, article_no, CASE
              WHEN k % 8 = 5 THEN ['']
              WHEN k % 8 = 2 THEN ['<r1.' || k || '@x.example>', '<r2.' || k || '@x.example>']
              WHEN k % 3 = 1 THEN ['<a.' || k || '@x.example>', '', '<b.' || k || '@x.example>']
              ELSE [''] END AS items FROM alive""",
            "list, article_no",
        )
    ),
    "dates": _alive(f"SELECT list, article_no, strftime(sent, {_TIME}) AS sent FROM alive"),
    "trailers": _alive("SELECT list, article_no, pos, attribution, identification FROM people"),
    "patches": _alive("""SELECT list, article_no, 0 AS pos, code1 AS item FROM alive WHERE code1 IS NOT NULL
      UNION ALL SELECT list, article_no, 1, code2 FROM alive WHERE code2 IS NOT NULL"""),
    "bodies": _alive("SELECT list, article_no, md5(body) AS body_md5 FROM alive"),
    "list_helpers": """SELECT p_partkey, len(string_split(p_name, ' ')) AS words,
      replace(p_name, ' ', ', ') AS joined FROM part""",
    "dead_letters": _mails(f"""SELECT list, article_no,
      CASE WHEN {_BROKEN} THEN 'content is not valid UTF-8'
        ELSE 'header starts with a continuation line' END AS error
      FROM mails WHERE {_BROKEN} OR {_STRAY}"""),
    "dead_letter_texts": _raw(f"""SELECT list, article_no, md5(whole
        || CASE WHEN {_BROKEN} THEN chr(65533) ELSE '' END || chr(10) || repeat('=', 30) || ' Exception:' || chr(10)
        || CASE WHEN {_BROKEN} THEN 'content is not valid UTF-8'
          ELSE 'header starts with a continuation line' END) AS text_md5
      FROM raw WHERE {_BROKEN} OR {_STRAY}"""),
    "raw_files": _raw("""SELECT list, article_no, octet_length(content) AS length, md5(content) AS content_md5
      FROM stored"""),
    "raw_scan": _raw("""SELECT list, count(*) AS mails, max(article_no) AS highest,
      CAST(sum(octet_length(content)) AS BIGINT) AS bytes FROM stored
      WHERE list IN ('list-user', 'src3') GROUP BY list"""),
    "parse_counts": _mails(f"""SELECT CASE WHEN {_BROKEN} OR {_STRAY} THEN 'errors' ELSE 'parsed' END AS outcome,
      list, count(*) AS mails FROM mails GROUP BY ALL"""),
    "stored_unnamed_list": _mails(
        _stage("with unnamed", "true", _UNNAMED)
        + " UNION ALL "
        + _stage("without", "list <> 'list-system'")
    ),
    "stored_versions": _mails(
        _stage("before", "true")
        + " UNION ALL "
        + _stage("after", "list <> 'list-user' OR article_no % 2 = 0")
    ),
    "tolerant_read": _alive("""SELECT list, count(*) AS mails, CAST(NULL AS BIGINT) AS broken_files FROM alive
      WHERE list <> 'list-system' GROUP BY list UNION ALL SELECT 'list-system', NULL, 1"""),
    "stored_mail": _alive(f"""SELECT list, article_no, sender, strftime(sent, {_TIME}) AS sent,
      (SELECT count(*) FROM people p WHERE p.list = alive.list AND p.article_no = alive.article_no) AS trailers,
      CAST(CASE k % 6 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS BIGINT) AS patches FROM alive"""),
    "stored_lists": _alive("SELECT DISTINCT list FROM alive"),
    "stored_some_lists": _alive("""SELECT list, count(*) AS mails FROM alive
      WHERE list IN ('list-user', 'src3') GROUP BY list"""),
    "stored_reparse": _alive("SELECT list, count(*) AS mails FROM alive GROUP BY list"),
    "landed_mails": _mails("""SELECT list, count(*) AS mails, CAST(sum(article_no) AS BIGINT) AS articles
      FROM mails GROUP BY list"""),
    "stored_dead_letters": _mails(f"""SELECT list, count(*) AS mails FROM mails
      WHERE ({_BROKEN} OR {_STRAY}) AND list <> 'list-user' GROUP BY list"""),
    "retried_mails": _mails(f"""SELECT list, count(*) AS raw,
      count(*) FILTER (NOT ({_STRAY})) AS parsed, count(*) FILTER ({_STRAY}) AS dead, CAST(0 AS BIGINT) AS missing
      FROM mails GROUP BY list"""),
    "reconcile": _mails(f"""SELECT list, raw, parsed, CAST(0 AS BIGINT) AS dead, raw - parsed AS missing,
      CASE WHEN raw = parsed THEN '' ELSE (raw - parsed) || ' emails missing!!' END AS note
      FROM (SELECT list, count(*) AS raw, count(*) FILTER (NOT ({_BROKEN}) AND NOT ({_STRAY})) AS parsed
        FROM mails GROUP BY list)"""),
    "reconcile_with_dead": _mails(f"""SELECT list, count(*) AS raw,
      count(*) FILTER (NOT ({_BROKEN}) AND NOT ({_STRAY})) AS parsed,
      count(*) FILTER ({_BROKEN} OR {_STRAY}) AS dead, CAST(0 AS BIGINT) AS missing, '' AS note
      FROM mails GROUP BY list"""),
    "reconcile_total": _mails(f"""SELECT raw, parsed, CAST(0 AS BIGINT) AS dead, raw - parsed AS missing,
      CASE WHEN raw = parsed THEN '' ELSE (raw - parsed) || ' emails missing!!' END AS note
      FROM (SELECT count(*) AS raw, count(*) FILTER (NOT ({_BROKEN}) AND NOT ({_STRAY})) AS parsed
        FROM mails)"""),
    "duplicate_ids": _alive("""SELECT list, message_id, count(*) AS mails FROM alive
      WHERE message_id <> '' GROUP BY list, message_id HAVING count(*) > 1"""),
    "missing_ids": _alive("SELECT list, article_no FROM alive WHERE message_id = ''"),
    "find_by_id": _alive("""SELECT list, article_no, 'Re: topic: ' || k AS subject FROM alive
      WHERE message_id = '<9.d@mail.example>'"""),
    "gap_ranges": _mails(_GAPS.format(source="mails")),
    "stored_reparse_emptied": _mails(f"""SELECT list, count(*) AS raw,
      count(*) FILTER (NOT ({_BROKEN}) AND NOT ({_STRAY}) AND list <> 'list-user') AS parsed,
      count(*) FILTER ({_BROKEN} OR {_STRAY} OR list = 'list-user') AS dead,
      CAST(0 AS BIGINT) AS missing FROM mails GROUP BY list"""),
    "gaps_by_batch": _mails(f"""SELECT list, unnest(range(first_missing, last_missing + 1)) AS article_no,
      'article unavailable' AS error FROM ({_GAPS.format(source="mails")})"""),
    "gaps_to_catalogue": _mails(f"""SELECT list, unnest(range(first_missing, last_missing + 1)) AS article_no,
      'article unavailable' AS error FROM ({_GAPS.format(source="""(SELECT list, article_no FROM mails
        UNION ALL SELECT list, unnest([-3, max(article_no) + 4]) FROM mails GROUP BY list
        UNION ALL SELECT 'list-empty', unnest([4, 10]))""")})"""),
    "gaps": _mails(f"""SELECT list, unnest(range(first_missing, last_missing + 1)) AS article_no,
      'article unavailable' AS error FROM ({_GAPS.format(source="mails")})"""),
    "order_gaps": """SELECT g.l_returnflag, g.n AS l_orderkey FROM (
        SELECT l_returnflag, unnest(generate_series(min(l_orderkey), max(l_orderkey))) AS n
        FROM lineitem GROUP BY l_returnflag) g
      ANTI JOIN lineitem l ON l.l_returnflag = g.l_returnflag AND l.l_orderkey = g.n""",
    "select_lists": _mails("""SELECT name AS list,
      CASE WHEN name IN (SELECT list FROM mails) THEN 1 ELSE 0 END AS available
      FROM (VALUES ('list-user'), ('src3'), ('no-such-list')) AS asked(name)"""),
    "select_all_lists": _mails("SELECT DISTINCT list FROM mails"),
    "article_range": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
      WHERE l_orderkey IN (1, 7) OR l_orderkey BETWEEN 100 AND 304""",
    "mails_after": _alive(f"""SELECT list, count(*) AS mails, strftime(min(sent), {_TIME}) AS first_date
      FROM alive WHERE sent > TIMESTAMP '2020-01-01' GROUP BY list"""),
    "hash_columns": "SELECT c_custkey, sha1(c_name) AS c_name FROM customer",
    "hash_keyed": f"""SELECT p_partkey, {_keyed("p_name")} AS name_digest,
      array_to_string(list_transform(string_split(p_name, ' '), lambda x: {_keyed("x")}), ',') AS digests FROM part""",
    "hash_missing_column": "SELECT c_custkey, sha1(c_name) AS c_name FROM customer",
    "hash_lists": _unfold(
        "SELECT p_partkey, list_transform(string_split(p_name, ' '), lambda x: sha1(x)) AS items FROM part",
        "p_partkey",
        "digest",
    ),
    "hash_fields": """SELECT p_partkey, 'name' AS kind, sha1(p_name) AS value FROM part
      UNION ALL SELECT p_partkey, 'brand', sha1(p_brand) FROM part""",
    "hash_struct": "SELECT p_partkey, sha1(p_name) AS name, p_size AS size FROM part",
    "identity_map": _alive("SELECT sender AS original, sha1(sender) AS pseudonym, list FROM alive"),
    "identity_map_distinct": """SELECT DISTINCT c_name AS original, sha1(c_name) AS pseudonym,
      o_orderpriority AS list FROM orders JOIN customer ON o_custkey = c_custkey""",
    "pseudonymised_mail": _alive(f"""SELECT list, article_no, sha1(sender) AS sender,
      array_to_string(list_transform({_receivers("x").replace(" AS x", "")}, lambda x: sha1(x)), ',') AS receivers,
      array_to_string(list_transform({_COPIES}, lambda x: sha1(x)), ',') AS copies,
      coalesce((SELECT string_agg(sha1(identification), ',' ORDER BY pos) FROM people p
        WHERE p.list = alive.list AND p.article_no = alive.article_no), '') AS people,
      coalesce((SELECT string_agg(attribution, ',' ORDER BY pos) FROM people p
        WHERE p.list = alive.list AND p.article_no = alive.article_no), '') AS roles
      FROM alive"""),
    "stored_archive": _alive("""SELECT list, dataset, count(*) AS mails, min(sha1(sender)) AS lowest
      FROM alive, (VALUES ('main'), ('map')) AS d(dataset) GROUP BY ALL"""),
    "list_sizes": _alive("SELECT list, count(sender) AS mails FROM alive GROUP BY list"),
    "list_extremes": f"""WITH s AS ({_SIZES})
      SELECT lo.source AS smallest_list, lo.mails AS smallest_mails,
             hi.source AS largest_list, hi.mails AS largest_mails
      FROM (SELECT * FROM s ORDER BY mails, source LIMIT 1) lo,
           (SELECT * FROM s ORDER BY mails DESC, source LIMIT 1) hi""",
    "size_quartiles": f"""SELECT quantile_cont(mails, 0.25) AS q1, quantile_cont(mails, 0.5) AS q2,
      quantile_cont(mails, 0.75) AS q3 FROM ({_SIZES})""",
    "size_report": f"""WITH s AS ({_SIZES})
      SELECT 'Min' AS stat, source AS list, CAST(mails AS DOUBLE) AS mails
        FROM (SELECT * FROM s ORDER BY mails, source LIMIT 1)
      UNION ALL SELECT 'Max', source, CAST(mails AS DOUBLE)
        FROM (SELECT * FROM s ORDER BY mails DESC, source LIMIT 1)
      UNION ALL SELECT 'Q1', NULL, quantile_cont(mails, 0.25) FROM s
      UNION ALL SELECT 'Q2', NULL, quantile_cont(mails, 0.5) FROM s
      UNION ALL SELECT 'Q3', NULL, quantile_cont(mails, 0.75) FROM s""",
    "author_list_counts": _AUTHORS,
    "author_lists": f"""SELECT c_name, string_agg(list || ':' || mails, ';' ORDER BY list) AS lists,
      CAST(sum(mails) AS BIGINT) AS mails FROM ({_AUTHORS}) GROUP BY c_name""",
    "author_lists_repeated": _alive(
        "SELECT sender AS original, sha1(sender) AS pseudonym, list FROM alive"
    ),
    "date_stats": f"""SELECT strftime((SELECT min(ts) FROM events), {_TIME}) AS min_date,
      strftime({_nearest("events", "ts", 0.25)}, {_TIME}) AS quartile_date""",
    "date_stats_discrete": f"""SELECT strftime(min(ts), {_TIME}) AS min_date,
      strftime(quantile_disc(ts, 0.25), {_TIME}) AS quartile_date FROM events""",
    "first_and_last": _alive(f"""SELECT strftime(min(sent), {_TIME}) AS first_date,
      strftime(max(sent), {_TIME}) AS last_date FROM alive"""),
    "profile_events": " UNION ALL ".join(
        _profile_row("events", c, kind)
        for c, kind in (
            ("event_id", "number"),
            ("user_id", "number"),
            ("event_type", "text"),
            ("value", "number"),
            ("ts", "time"),
            ("props", "text"),
        )
    ),
    "profile_mail": _alive(
        f""", profiled AS (SELECT sender AS "from", [] AS "to", [] AS cc, {_SUBJECT} AS "subject",
          sent AS "date", message_id AS "message-id",
          CASE WHEN k % 8 <> 5 AND k % 3 = 1 THEN '<' || (k - 1) || '.' || src || '@mail.example>'
            ELSE '' END AS "in-reply-to", [] AS "references",
          CASE WHEN k % 8 = 7 THEN 'box' || (k % 5) || '@lists.example' ELSE '' END AS "x-mailing-list",
          [] AS trailers, [] AS code, body AS raw_body, list FROM alive) """
        + " UNION ALL ".join(
            _profile_row("profiled", c, kind)
            for c, kind in (
                ("from", "text"),
                ("to", "list"),
                ("cc", "list"),
                ("subject", "text"),
                ("date", "time"),
                ("message-id", "text"),
                ("in-reply-to", "text"),
                ("references", "list"),
                ("x-mailing-list", "text"),
                ("trailers", "list"),
                ("code", "list"),
                ("raw_body", "text"),
                ("list", "text"),
            )
        )
    ),
    "dates_loose": _alive(f"""SELECT list, article_no, strftime(CASE k % 17
      WHEN 4 THEN TIMESTAMP '2012-06-15 16:52:00' + to_seconds(article_no % 60) ELSE sent END, {_TIME}) AS sent
      FROM alive"""),
    "reports": f"""WITH s AS ({_SIZES}), r AS (
      SELECT 'Min' AS stat, source AS list, CAST(mails AS DOUBLE) AS mails
        FROM (SELECT * FROM s ORDER BY mails, source LIMIT 1)
      UNION ALL SELECT 'Max', source, CAST(mails AS DOUBLE)
        FROM (SELECT * FROM s ORDER BY mails DESC, source LIMIT 1)
      UNION ALL SELECT 'Q1', NULL, quantile_cont(mails, 0.25) FROM s
      UNION ALL SELECT 'Q2', NULL, quantile_cont(mails, 0.5) FROM s
      UNION ALL SELECT 'Q3', NULL, quantile_cont(mails, 0.75) FROM s)
      SELECT 'list_sizes' AS report, stat AS name,
        concat_ws(' ', list, CAST(CAST(mails AS DECIMAL(20, 2)) AS VARCHAR)) AS value FROM r
      UNION ALL SELECT 'date_stats', 'min_date', strftime(min(ts), {_TIME}) FROM events
      UNION ALL SELECT 'date_stats', 'quartile_date', strftime({_nearest("events", "ts", 0.25)}, {_TIME})
      UNION ALL SELECT 'unique_authors', c_name, CAST(sum(mails) AS VARCHAR) FROM ({_AUTHORS}) GROUP BY c_name""",
    "value_quantiles": f"""SELECT {_nearest("lineitem", "l_extendedprice", 0.01)} AS p1,
      {_nearest("lineitem", "l_extendedprice", 0.5)} AS p50,
      {_nearest("lineitem", "l_extendedprice", 0.99)} AS p99, 'nearest' AS rule
      UNION ALL SELECT quantile_disc(l_extendedprice, 0.01), quantile_disc(l_extendedprice, 0.5),
      quantile_disc(l_extendedprice, 0.99), 'discrete' FROM lineitem""",
    "rolling_activity": _alive(
        ","
        + _rolling(
            "SELECT sent AS ts, list AS grp, reviewed, tested FROM alive WHERE sent > TIMESTAMP '2020-01-01'",
            "SELECT DISTINCT grp FROM src",
            60,
            5,
            _ROLLING_VALUES,
        )
        + _ACTIVITY
    ),
    "rolling_some_lists": _alive(
        ","
        + _rolling(
            """SELECT sent AS ts, list AS grp, reviewed, tested FROM alive
               WHERE list IN ('list-user', 'src3')""",
            "SELECT unnest(['list-user', 'src3', 'no-such-list']) AS grp",
            90,
            7,
            _ROLLING_VALUES,
        )
        + _ACTIVITY
    ),
    "rolling_events": "WITH"
    + _rolling(
        "SELECT ts, event_type AS grp, 1 AS events, user_id AS users FROM events",
        "SELECT DISTINCT grp FROM src",
        5,
        1,
        {"events": "events", "users": "users"},
    )
    + "SELECT sample_ts, grp AS event_type, events, users FROM rolled",
    "ingest_once": _mails("""SELECT list, count(*) AS mails, max(article_no) AS last_article
      FROM mails GROUP BY list"""),
    "ingest_twice": _mails("""SELECT list, count(*) AS mails,
      count(*) FILTER (src = 'd') AS batches, max(article_no) AS last_article
      FROM mails GROUP BY list"""),
    "ingest_twice_contents": _raw("""SELECT list, article_no,
      CASE WHEN src = 'd' THEN md5(article_no::VARCHAR) ELSE md5(content) END AS content_md5 FROM stored"""),
    "ingest_compacted": _mails("""SELECT list, count(*) AS mails, count(*) FILTER (src = 'd') AS batches
      FROM mails GROUP BY list"""),
    "ingest_late_files": _mails("""SELECT list, CAST(CASE WHEN src = 'd' THEN 0 ELSE 1 END AS BIGINT) AS batch,
      count(*) AS mails FROM mails GROUP BY ALL"""),
    "stream_files": _mails("""SELECT list, count(*) AS mails, count(DISTINCT article_no) AS articles,
      1 AS restarted FROM mails GROUP BY list"""),
    "batch_rewritten": _mails("""SELECT list, count(*) AS mails, max(article_no) AS last_article
      FROM mails WHERE src = 'd' GROUP BY list"""),
    "ingest_status": _mails("""SELECT list, max(article_no) + 10 AS high, max(article_no) AS last_article,
      count(*) AS new_mails, CAST(10 AS BIGINT) AS backlog,
      round(max(article_no) / (max(article_no) + 10) * 100, 2) AS percent,
      'Collected ' || count(*) || ' new e-mails from "' || list || '"' AS status
      FROM mails GROUP BY list
      UNION ALL SELECT 'list-empty', 0, 0, 0, 0, NULL, 'No New e-mails from "list-empty"'"""),
    "new_articles": _mails("""SELECT m.list, m.article_no FROM mails m LEFT JOIN
      (SELECT list, CAST(floor(max(article_no) / 2) AS BIGINT) AS mark FROM mails
        WHERE list <> 'src3' GROUP BY list) USING (list)
      WHERE m.article_no >= coalesce(mark, 0)"""),
    "backfilled": _mails("""SELECT list, count(*) AS mails, max(article_no) AS last_article FROM mails
      WHERE src = 'd' OR (list = 'list-user'
        AND (article_no IN (3, 23) OR article_no BETWEEN 43 AND 83 OR article_no BETWEEN 100 AND 302))
      GROUP BY list"""),
}
