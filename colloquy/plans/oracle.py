"""DuckDB SQL for the named plans (the correctness oracle).

Each entry recomputes its query from the raw parquet views with plain SQL
(CTEs, window functions, ordered ``string_agg``), independent of the Spark
code.  Shared steps are SQL fragments composed below.

Edit distance: DuckDB's ``levenshtein`` counts bytes, Spark's code points.  The
oracle therefore re-encodes the compared strings first: every non-ASCII
character that occurs is mapped (``translate``) to an ASCII code that does not
occur, so byte distance equals character distance.  That needs at most 127
distinct characters in the compared texts (the test conversations have 76).
"""

from __future__ import annotations

from colloquy.plans.catalogue import (CHECKED_SELECTION, CHUNK_COUNTS, GIVEN_RUNS, GROUP_SELECTION, PROMPTS,
                                      REQUEST_RUNS, RUN_SELECTION, SCORE_FILE_SUFFIX)
from colloquy.operators.requests import CLAUDE_MODEL_IDS, LLAMA_MODEL_IDS, STAGE_DEFAULTS
from colloquy.operators.runs import CATALOGUE, GROUP_CATALOGUE
from colloquy.operators.sentences import ABBREVIATIONS
from colloquy.sources.tables import GOLD_LABEL, MODEL_LABEL, RUNS, SECONDS_PER_TURN, SWAPPED_LABEL

N = 3
WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}"
      r"\x{2029}\x{202f}\x{205f}\x{3000}]+")
SPACE = r"[ \t\n\r\f\x0B]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lit(s: str) -> str:
    """SQL expression for a string that may hold control characters."""
    parts, buf = [], ""
    for ch in s:
        if ch in "\n\r\t":
            if buf:
                parts.append(q(buf))
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append(q(buf))
    return "(" + " || ".join(parts) + ")"


def seg(pos: str, n: str, k: str) -> str:
    return (f"CAST(CASE WHEN {n} // {k} = 0 THEN {k} - 1 "
            f"ELSE least({pos} // ({n} // {k}), {k} - 1) END AS INTEGER)")


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS)}, ' ', 'g'))"


def canon(s: str) -> str:
    b = f"trim(regexp_replace({s}, '[*_#]', '', 'g'))"
    return (f"(CASE WHEN {s} IS NULL THEN NULL WHEN contains(lower({s}), 'student') THEN 'Student' "
            f"WHEN contains(lower({s}), 'patient') THEN 'Patient' "
            f"ELSE upper(substr({b}, 1, 1)) || lower(substr({b}, 2)) END)")


def lines_of(v: str) -> str:
    parts = f"regexp_split_to_array({v}, '\\r\\n|\\r|\\n')"
    return (f"(CASE WHEN {v} = '' OR regexp_matches({v}, '[\\r\\n]$') "
            f"THEN list_slice({parts}, 1, len({parts}) - 1) ELSE {parts} END)")


def label_case(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {col} {whens} ELSE {q(default)} END)"


def k(keys: list[str], alias: str | None = None) -> str:
    return ", ".join(f"{alias}.{c}" if alias else c for c in keys)


# ---------------------------------------------------------------- base CTEs
def base_ctes() -> list[str]:
    runs = ", ".join(f"({q(r.run_name)}, {r.swap_every}, {r.drop_every}, {r.chunk_num}, "
                     f"{q(r.model)}, {q(r.prompt)}, {str(r.summary).upper()})" for r in RUNS)
    return [
        "conv AS (SELECT CAST(conv_id AS VARCHAR) AS id, conv_id, turn, CAST(turn AS INTEGER) AS pos, "
        "role, text FROM conversations)",
        f"runs(run_name, swap_every, drop_every, chunk_num, model, prompt, summary) AS (VALUES {runs})",
        f"gold_turns AS (SELECT id, pos, {label_case('role', GOLD_LABEL, 'instructions')} AS speaker, "
        "text FROM conv)",
        "pred_turns AS (SELECT r.run_name, c.id, c.pos, r.chunk_num, "
        f"CASE WHEN (c.conv_id * 5 + c.turn * 11 + 1) % r.swap_every = 0 "
        f"THEN {label_case('c.role', SWAPPED_LABEL, 'Patient')} "
        f"ELSE {label_case('c.role', MODEL_LABEL, 'Instructions')} END AS speaker, "
        "CASE WHEN (c.conv_id + c.turn) % r.drop_every = 1 THEN replace(c.text, ' the ', ' ') "
        "ELSE c.text END AS text FROM conv c CROSS JOIN runs r)",
    ]


def answer_ctes() -> list[str]:
    """Model answers per (run, id, chunk), empty chunks included."""
    nl2 = lit("\n\n")
    return [
        "pred_n AS (SELECT run_name, id, chunk_num, count(*) AS n_rows FROM pred_turns GROUP BY ALL)",
        f"pred_chunked AS (SELECT t.*, {seg('t.pos', 'n.n_rows', 't.chunk_num')} AS chunk "
        "FROM pred_turns t JOIN pred_n n USING (run_name, id, chunk_num))",
        f"answers_ne AS (SELECT run_name, id, chunk, string_agg(speaker || ': ' || text, {nl2} "
        "ORDER BY pos) AS answer FROM pred_chunked GROUP BY ALL)",
        "answers AS (SELECT g.run_name, g.id, CAST(g.chunk AS INTEGER) AS chunk, "
        "coalesce(a.answer, '') AS answer FROM (SELECT run_name, id, unnest(range(chunk_num)) AS chunk "
        "FROM pred_n) g LEFT JOIN answers_ne a USING (run_name, id, chunk))",
    ]


def pred_file_cte(chunked: bool = False) -> str:
    nl2 = lit("\n\n")
    body = f"answer || {nl2}"
    if chunked:
        body = f"'chunk ' || CAST(chunk AS VARCHAR) || ':' || {nl2} || {body}"
    return (f"pred_files AS (SELECT run_name, id, string_agg({body}, '' ORDER BY chunk) AS value "
            "FROM answers GROUP BY ALL)")


def gold_file_cte() -> str:
    return (f"gold_files AS (SELECT id, string_agg(speaker || ': ' || text, {lit(chr(10) * 2)} "
            "ORDER BY pos) AS value FROM gold_turns GROUP BY id)")


def lines_cte(name: str, files: str, keys: list[str], value: str = "value") -> str:
    return (f"{name} AS (SELECT {k(keys)}, CAST(unnest(range(len(l))) AS INTEGER) AS pos, "
            f"unnest(l) AS line, CAST(len(l) AS INTEGER) AS n_rows "
            f"FROM (SELECT {k(keys)}, {lines_of(value)} AS l FROM {files}))")


def seg_text_ctes(prefix: str, lines: str, files: str, keys: list[str], n: int, mode: str,
                  with_labelled: bool = True, with_bare: bool = True,
                  segment_by: str = "line") -> list[str]:
    """Per-segment labelled / bare texts from physical lines -> CTE ``{prefix}_seg``."""
    part = k(keys + ["segment"])
    ctes = []
    if segment_by == "turn":
        starts = f"CASE WHEN instr(line, ':') > 0 AND length({collapse('line')}) > 0 THEN 1 ELSE 0 END"
        ctes.append(
            f"{prefix}_turnno AS (SELECT {k(keys)}, pos, line, "
            f"greatest(sum(st) OVER (PARTITION BY {k(keys)} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND CURRENT ROW) - 1, 0) AS turn, sum(st) OVER (PARTITION BY {k(keys)}) AS n_turns "
            f"FROM (SELECT *, {starts} AS st FROM {lines}))")
        lines, seg_expr = f"{prefix}_turnno", seg("turn", "n_turns", str(n))
    else:
        seg_expr = seg("pos", "n_rows", str(n))
    ctes += [
        f"{prefix}_parsed AS (SELECT {k(keys)}, pos, line, {seg_expr} AS segment, "
        f"CASE WHEN instr(line, ':') > 0 THEN {canon('substr(line, 1, instr(line, chr(58)) - 1)')} END AS sp, "
        "CASE WHEN instr(line, ':') > 0 THEN substr(line, instr(line, ':') + 1) ELSE line END AS tx, "
        f"regexp_replace(line, '^[^ ]*', '') AS bare_piece FROM {lines})",
    ]
    if mode == "canonical":
        kept = f"(SELECT * FROM {prefix}_parsed WHERE length({collapse('line')}) > 0)" \
            if with_labelled else f"{prefix}_parsed"
        ctes += [
            f"{prefix}_filled AS (SELECT *, coalesce(last_value(sp IGNORE NULLS) OVER (PARTITION BY {part} "
            f"ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Unknown') AS spk FROM {kept})",
            f"{prefix}_pieces AS (SELECT *, CASE WHEN lag(spk) OVER (PARTITION BY {part} ORDER BY pos) "
            f"IS DISTINCT FROM spk THEN spk || ':' || tx ELSE tx END AS piece FROM {prefix}_filled)",
            f"{prefix}_agg AS (SELECT {part}, string_agg(piece, ' ' ORDER BY pos) AS l, "
            f"string_agg(bare_piece, '' ORDER BY pos) AS b FROM {prefix}_pieces GROUP BY ALL)",
        ]
    else:
        ctes += [
            f"{prefix}_agg AS (SELECT {part}, 'Student:' || string_agg(tx, chr(10) ORDER BY pos) AS l, "
            f"string_agg(bare_piece, '' ORDER BY pos) AS b FROM {prefix}_parsed GROUP BY ALL)",
        ]
    cols = []
    if with_labelled:
        cols.append(f"{collapse('coalesce(a.l, chr(32))')} AS labelled")
    if with_bare:
        cols.append(f"{collapse('coalesce(a.b, chr(32))')} AS bare")
    ctes.append(
        f"{prefix}_seg AS (SELECT {k(keys, 'g')}, CAST(g.segment AS INTEGER) AS segment, {', '.join(cols)} "
        f"FROM (SELECT {k(keys)}, unnest(range({n})) AS segment FROM {files}) g "
        f"LEFT JOIN {prefix}_agg a USING ({part}))")
    return ctes


def json_turn_ctes() -> list[str]:
    """Answers -> parsed turns -> JSON rows with their array position."""
    nl2 = lit("\n\n")
    return [
        f"blocks AS (SELECT run_name, id, chunk, unnest(string_split(answer, {nl2})) AS b, "
        f"CAST(unnest(range(len(string_split(answer, {nl2})))) AS INTEGER) AS block FROM answers)",
        "jturns AS (SELECT run_name, id, chunk, block, substr(b, 1, instr(b, ':') - 1) AS speaker, "
        "substr(b, instr(b, ':') + 1) AS text FROM blocks WHERE instr(b, ':') > 0)",
        "jfiles AS (SELECT DISTINCT run_name, id FROM answers)",
        "jrows AS (SELECT run_name, id, speaker, text, "
        "CAST(row_number() OVER (PARTITION BY run_name, id ORDER BY chunk, block) - 1 AS INTEGER) AS pos, "
        "CAST(count(*) OVER (PARTITION BY run_name, id) AS INTEGER) AS n_rows FROM jturns)",
    ]


def json_seg_ctes(prefix: str, n: int, mode: str) -> list[str]:
    keys = ["run_name", "id"]
    part = k(keys + ["segment"])
    ctes = [f"{prefix}_rows AS (SELECT *, {seg('pos', 'n_rows', str(n))} AS segment FROM jrows)"]
    if mode == "canonical":
        ctes += [
            f"{prefix}_pieces AS (SELECT *, CASE WHEN lag({canon('speaker')}) OVER (PARTITION BY {part} "
            f"ORDER BY pos) IS DISTINCT FROM coalesce({canon('speaker')}, 'Unknown') "
            f"THEN coalesce({canon('speaker')}, 'Unknown') || ':' || text ELSE text END AS piece "
            f"FROM {prefix}_rows)",
            f"{prefix}_agg AS (SELECT {part}, string_agg(piece, ' ' ORDER BY pos) AS l, "
            f"string_agg(text, '' ORDER BY pos) AS b FROM {prefix}_pieces GROUP BY ALL)",
        ]
    else:
        ctes.append(f"{prefix}_agg AS (SELECT {part}, 'Student:' || string_agg(text, '' ORDER BY pos) AS l, "
                    f"string_agg(text, '' ORDER BY pos) AS b FROM {prefix}_rows GROUP BY ALL)")
    ctes.append(
        f"{prefix}_seg AS (SELECT g.run_name, g.id, CAST(g.segment AS INTEGER) AS segment, "
        f"{collapse('coalesce(a.l, chr(32))')} AS labelled, {collapse('coalesce(a.b, chr(32))')} AS bare "
        f"FROM (SELECT run_name, id, unnest(range({n})) AS segment FROM jfiles) g "
        f"LEFT JOIN {prefix}_agg a USING ({part}))")
    return ctes


def raw_ctes(n: int, normalise: str = "always", keys_src: str = "conv") -> list[str]:
    text = collapse("coalesce(a.t, '')")
    if normalise == "literal" and n == 1:
        text = "coalesce(a.t, '')"
    return [
        f"raw_n AS (SELECT id, count(*) AS n_rows FROM {keys_src} GROUP BY id)",
        f"raw_rows AS (SELECT c.id, c.pos, {seg('c.pos', 'n.n_rows', str(n))} AS segment, "
        f"CASE WHEN c.text <> chr(10) THEN ' ' || c.text END AS piece FROM {keys_src} c JOIN raw_n n USING (id))",
        "raw_agg AS (SELECT id, segment, string_agg(piece, '' ORDER BY pos) AS t, count(*) AS n_utt "
        "FROM raw_rows GROUP BY ALL)",
        f"raw_seg AS (SELECT g.id, CAST(g.segment AS INTEGER) AS segment, {text} AS text, "
        f"coalesce(a.n_utt, 0) AS n_utterances FROM (SELECT id, unnest(range({n})) AS segment FROM raw_n) g "
        "LEFT JOIN raw_agg a USING (id, segment))",
    ]


def codec_ctes(strings: list[str]) -> list[str]:
    union = " UNION ALL ".join(strings)
    return [
        f"strs AS ({union})",
        "alphabet AS (SELECT DISTINCT unnest(string_split(s, '')) AS ch FROM strs)",
        "nonascii AS (SELECT ch, row_number() OVER (ORDER BY ch) AS k FROM alphabet WHERE ord(ch) > 127)",
        "freecodes AS (SELECT code, row_number() OVER (ORDER BY code) AS k FROM range(1, 128) t(code) "
        "WHERE chr(CAST(code AS INTEGER)) NOT IN (SELECT ch FROM alphabet))",
        "codec AS (SELECT coalesce(string_agg(n.ch, '' ORDER BY n.k), '') AS src, "
        "coalesce(string_agg(chr(CAST(f.code AS INTEGER)), '' ORDER BY n.k), '') AS dst "
        "FROM nonascii n JOIN freecodes f USING (k))",
    ]


def lev(a: str, b: str) -> str:
    enc_a = f"translate({a}, codec.src, codec.dst)"
    enc_b = f"translate({b}, codec.src, codec.dst)"
    return (f"(CASE WHEN {a} = {b} THEN CAST(1.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) - "
            f"CAST(levenshtein({enc_a}, {enc_b}) AS DOUBLE) / greatest(length({a}), length({b})) END)")


def with_(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# ---------------------------------------------------------------- diff ratio
def stretch(source: str, name: str, most: str, a: str, b: str, back: bool) -> str:
    """Subquery: ``source`` and ``name``, how many characters (at most ``most``)
    of ``a`` and ``b`` are equal from the 1-based places ``a_at``, ``b_at`` on, or
    up to there when ``back``; found by adding powers of two, the largest first."""
    query = f"SELECT *, 0 AS {name}_0 FROM ({source})"
    powers = [1 << p for p in range(20, -1, -1)]
    for step, p in enumerate(powers):
        done = f"{name}_{step}"
        at = (lambda x: f"{x}_at - {done} - {p - 1}") if back else (lambda x: f"{x}_at + {done}")
        query = (f"SELECT * EXCLUDE ({done}), CASE WHEN {done} + {p} <= {most} "
                 f"AND substr({a}, {at('a')}, {p}) = substr({b}, {at('b')}, {p}) THEN {done} + {p} ELSE {done} END "
                 f"AS {name}_{step + 1} FROM ({query})")
    return f"SELECT * EXCLUDE ({name}_{len(powers)}), {name}_{len(powers)} AS {name} FROM ({query})"


def diff_ctes(pairs: str) -> list[str]:
    """CTEs ending in ``diff_ratios`` (a, b, ratio) for the distinct pairs of the
    query ``pairs`` (a, b), texts in ASCII codes.  A row of ``parts`` is a part of a pair still to
    be matched: its longest run of characters that are not popular (ties to the
    least place in a, then in b), prolonged by all characters, leaves two parts."""
    longest = ("SELECT w.pid, w.alo, w.ahi, w.blo, w.bhi, "
               "max(((least(r.stop, w.ahi, w.bhi - r.d) - greatest(r.start, w.alo, w.blo - r.d)) << 42) + "
               f"(({(1 << 21) - 1} - greatest(r.start, w.alo, w.blo - r.d)) << 21) + "
               f"({(1 << 21) - 1} - greatest(r.start, w.alo, w.blo - r.d) - r.d)) AS best "
               "FROM parts w LEFT JOIN diagonal_runs r ON r.pid = w.pid "
               "AND least(r.stop, w.ahi, w.bhi - r.d) > greatest(r.start, w.alo, w.blo - r.d) "
               "WHERE w.alo < w.ahi AND w.blo < w.bhi GROUP BY w.pid, w.alo, w.ahi, w.blo, w.bhi")
    low = (1 << 21) - 1
    found = ("SELECT m.* EXCLUDE (best), p.a, p.b, coalesce(best >> 42, 0) AS n, "
             f"coalesce({low} - ((best >> 21) & {low}), alo) AS i, coalesce({low} - (best & {low}), blo) AS j "
             f"FROM ({longest}) m JOIN diff_pairs p USING (pid)")
    before = stretch(f"SELECT *, i AS a_at, j AS b_at FROM ({found})", "more", "least(i - alo, j - blo)", "a", "b", True)
    after = stretch(f"SELECT * REPLACE (i + n + 1 AS a_at, j + n + 1 AS b_at) FROM ({before})", "further",
                    "least(ahi - i - n, bhi - j - n)", "a", "b", False)
    left = "{'alo': alo, 'ahi': i - more, 'blo': blo, 'bhi': j - more, 'size': more + n + further}"
    right = "{'alo': i + n + further, 'ahi': ahi, 'blo': j + n + further, 'bhi': bhi, 'size': 0}"
    return [
        f"diff_pairs AS MATERIALIZED (SELECT row_number() OVER () AS pid, a, b FROM (SELECT DISTINCT a, b FROM ({pairs}) "
        "WHERE a <> b AND a <> '' AND b <> ''))",
        "b_places AS (SELECT pid, length(b) AS len, unnest(range(length(b))) AS j, unnest(string_split(b, '')) AS ch "
        "FROM diff_pairs)",
        "rare AS (SELECT pid, ch FROM b_places GROUP BY pid, ch, len HAVING len < 200 OR count(*) <= len // 100 + 1)",
        "a_places AS (SELECT pid, unnest(range(length(a))) AS i, unnest(string_split(a, '')) AS ch FROM diff_pairs)",
        "points AS (SELECT x.pid, x.i, y.j - x.i AS d FROM a_places x JOIN rare USING (pid, ch) "
        "JOIN b_places y USING (pid, ch))",
        "diagonal_runs AS MATERIALIZED (SELECT pid, d, min(i) AS start, max(i) + 1 AS stop FROM (SELECT pid, d, i, "
        "i - row_number() OVER (PARTITION BY pid, d ORDER BY i) AS island FROM points) GROUP BY pid, d, island)",
        "parts AS (SELECT pid, CAST(0 AS BIGINT) AS alo, length(a) AS ahi, CAST(0 AS BIGINT) AS blo, length(b) AS bhi, "
        "CAST(0 AS BIGINT) AS size FROM diff_pairs UNION ALL "
        "SELECT pid, c.alo, c.ahi, c.blo, c.bhi, c.size FROM (SELECT pid, unnest([" + left + ", " + right + "]) AS c "
        f"FROM ({after}) WHERE more + n + further > 0))",
        "diff_ratios AS (SELECT a, b, CAST(2 * sum(size) AS DOUBLE) / (length(a) + length(b)) AS ratio "
        "FROM parts JOIN diff_pairs USING (pid) GROUP BY a, b)",
    ]


def diff_scores_ctes() -> list[str]:
    """``diff_scores`` (run_name, id, segment, diff_*) from pred_seg, gold_seg, raw_seg and codec."""
    ascii_ = lambda x: f"translate({x}, codec.src, codec.dst)"
    value = lambda a, b, k: (f"(CASE WHEN {a} = {b} THEN CAST(1.0 AS DOUBLE) "  # noqa: E731
                             f"WHEN {a} = '' OR {b} = '' THEN CAST(0.0 AS DOUBLE) ELSE {k}.ratio END)")
    trio = [("raw", "bare", "diff_pres"), ("bare", "gold", "diff_baseline"), ("gold", "pred", "diff_acc")]
    joins = " ".join(f"LEFT JOIN diff_ratios x{k} ON x{k}.a = t.{a} AND x{k}.b = t.{b}"
                     for k, (a, b, _) in enumerate(trio))
    return [
        f"diff_texts AS MATERIALIZED (SELECT p.run_name, p.id, p.segment, {ascii_('p.bare')} AS bare, "
        f"{ascii_('p.labelled')} AS pred, {ascii_('g.labelled')} AS gold, {ascii_('r.text')} AS raw FROM pred_seg p "
        "LEFT JOIN gold_seg g USING (id, segment) LEFT JOIN raw_seg r USING (id, segment) CROSS JOIN codec)",
        *diff_ctes(" UNION ALL ".join(f"SELECT {a} AS a, {b} AS b FROM diff_texts" for a, b, _ in trio)),
        "diff0 AS (SELECT t.run_name, t.id, t.segment, "
        + ", ".join(f"{value(f't.{a}', f't.{b}', f'x{k}')} AS {name}" for k, (a, b, name) in enumerate(trio))
        + f" FROM diff_texts t {joins})",
        "diff_scores AS (SELECT *, (diff_acc - diff_baseline) / nullif(CAST(1.0 AS DOUBLE) - diff_baseline, 0) "
        "AS diff_acc_normed FROM diff0)",
        "all_scores AS (SELECT *, (lev_acc + diff_acc) / 2 AS composite, "
        "(lev_acc_normed + diff_acc_normed) / 2 AS composite_normed FROM scores JOIN diff_scores "
        "USING (run_name, id, segment))",
    ]


# ----------------------------------------------------------- scoring queries
def pred_ctes(n: int, mode: str, source: str, with_labelled=True, with_bare=True,
              segment_by: str = "line") -> list[str]:
    ctes = base_ctes() + answer_ctes()
    if source == "txt":
        ctes += [pred_file_cte(), lines_cte("pred_lines", "pred_files", ["run_name", "id"])]
        ctes += seg_text_ctes("pred", "pred_lines", "pred_files", ["run_name", "id"], n, mode,
                              with_labelled, with_bare, segment_by)
    else:
        ctes += json_turn_ctes() + json_seg_ctes("pred", n, mode)
    return ctes


def gold_ctes(n: int, mode: str, segment_by: str = "line") -> list[str]:
    return [gold_file_cte(), lines_cte("gold_lines", "gold_files", ["id"])] + \
        seg_text_ctes("gold", "gold_lines", "gold_files", ["id"], n, mode, True, False, segment_by)


def scored_sql(n: int = N, families=("preservation", "accuracy"), mode: str = "canonical",
               source: str = "txt", raw_normalise: str = "always",
               segment_by: str = "line") -> tuple[list[str], list[str]]:
    """CTEs ending in ``scores`` (run_name, id, segment, lev_* columns); returns
    (ctes, score column names)."""
    ctes = pred_ctes(n, mode, source, segment_by=segment_by)
    strings = ["SELECT labelled AS s FROM pred_seg", "SELECT bare FROM pred_seg"]
    cols = []
    joins = ""
    if "accuracy" in families:
        ctes += gold_ctes(n, mode, segment_by)
        strings.append("SELECT labelled FROM gold_seg")
        joins += " LEFT JOIN gold_seg g USING (id, segment)"
    if "preservation" in families:
        ctes += raw_ctes(n, raw_normalise)
        strings.append("SELECT text FROM raw_seg")
        joins += " LEFT JOIN raw_seg r USING (id, segment)"
    ctes += codec_ctes(strings)
    sel = []
    if "preservation" in families:
        sel.append(f"{lev('r.text', 'p.bare')} AS lev_pres")
        cols.append("lev_pres")
    if "accuracy" in families:
        sel += [f"{lev('p.bare', 'g.labelled')} AS lev_baseline", f"{lev('g.labelled', 'p.labelled')} AS lev_acc"]
        cols += ["lev_baseline", "lev_acc"]
    ctes.append(f"scores0 AS (SELECT p.run_name, p.id, p.segment, {', '.join(sel)} "
                f"FROM pred_seg p{joins} CROSS JOIN codec)")
    if "accuracy" in families:
        ctes.append("scores AS (SELECT *, (lev_acc - lev_baseline) / nullif(CAST(1.0 AS DOUBLE) - lev_baseline, 0) "
                    "AS lev_acc_normed FROM scores0)")
        cols.append("lev_acc_normed")
    else:
        ctes.append("scores AS (SELECT * FROM scores0)")
    return ctes, cols


def r6(cols: list[str], alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(f"round({pre}{c}, 6) AS {c}" for c in cols)


def score_select(cols: list[str], **kw) -> str:
    ctes, _ = scored_sql(**kw)
    return with_(ctes, f"SELECT run_name, id, segment, {r6(cols)} FROM scores")


def means_select(n: int, by_segment: bool) -> str:
    ctes, cols = scored_sql(n=n)
    avgs = ", ".join(f"round(avg(CASE WHEN isnan({c}) THEN NULL ELSE {c} END), 6) AS {c}" for c in cols)
    if by_segment:
        names = ", ".join(cols)
        return with_(ctes + [f"m AS (SELECT run_name, segment, count(*) AS n_rows, {avgs} FROM scores "
                             "GROUP BY run_name, segment)"],
                     "SELECT run_name, segment, CAST(max(segment) OVER (PARTITION BY run_name) + 1 AS INTEGER) "
                     f"AS n_segments, n_rows, {names} FROM m")
    return with_(ctes, f"SELECT run_name, count(*) AS n_rows, {avgs} FROM scores GROUP BY run_name")


def selection_values(sel: list[tuple[str, str]]) -> str:
    return ", ".join(f"({i}, {q(r)}, {q(lab)})" for i, (r, lab) in enumerate(sel))


# ------------------------------------------------------------ other queries
def sentences_sql() -> str:
    alts = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    abbr = r"(^|[^A-Za-z])(" + alts + r")\."
    end = r"([.!?]+)" + SPACE + "+"
    edge = "^" + SPACE + "+|" + SPACE + "+$"
    protected = f"regexp_replace(text, {q(abbr)}, '\\1\\2' || chr(57344), 'g')"
    marked = f"regexp_replace({protected}, {q(end)}, '\\1' || chr(57345), 'g')"
    parts = (f"list_filter(list_transform(string_split({marked}, chr(57345)), "
             f"lambda p: regexp_replace(replace(p, chr(57344), '.'), {q(edge)}, '', 'g')), "
             f"lambda p: length(p) > 0)")
    return ("SELECT id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence FROM "
            f"(SELECT CAST(doc_id AS VARCHAR) AS id, {parts} AS l FROM documents)")


def requests_sql(summary_mode: str) -> str:
    """summary_mode: 'per_chunk' (model_requests) or 'whole' (summary_join)."""
    prompts = ", ".join(f"({q(a)}, {q(b)})" for a, b in PROMPTS)
    alias = {name: " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in ids.items())
             for name, ids in (("claude", CLAUDE_MODEL_IDS), ("llama", LLAMA_MODEL_IDS))}
    columns = [f for f in REQUEST_RUNS[0].__dataclass_fields__]
    value = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else str(v).upper()
    runs = ", ".join("(" + ", ".join(value(getattr(r, c)) for c in columns) + ")" for r in REQUEST_RUNS)
    nl2 = lit("\n\n")
    ctes = [
        "conv AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, text FROM conversations)",
        f"runs({', '.join(columns)}) AS (VALUES {runs})",
        f"prompts(prompt_name, ptext) AS (VALUES {prompts})",
        "rc AS (SELECT r.run_name, r.chunk_num, c.id, c.pos, c.text FROM conv c CROSS JOIN runs r)",
        "rn AS (SELECT run_name, chunk_num, id, count(*) AS n_rows FROM rc GROUP BY ALL)",
        f"rrows AS (SELECT rc.*, {seg('rc.pos', 'rn.n_rows', 'rc.chunk_num')} AS chunk FROM rc "
        "JOIN rn USING (run_name, chunk_num, id))",
        "cagg AS (SELECT run_name, id, chunk, string_agg(CASE WHEN text <> chr(10) THEN ' ' || text END, '' "
        "ORDER BY pos) AS t FROM rrows GROUP BY ALL)",
        "chunks AS (SELECT g.run_name, g.id, CAST(g.chunk AS INTEGER) AS chunk, coalesce(a.t, '') AS text "
        "FROM (SELECT run_name, id, unnest(range(chunk_num)) AS chunk FROM rn) g "
        "LEFT JOIN cagg a USING (run_name, id, chunk))",
        f"joined AS (SELECT run_name, id, CAST(NULL AS INTEGER) AS chunk, string_agg(text || {nl2}, '' ORDER BY chunk) "
        "AS text FROM chunks GROUP BY run_name, id)",
        "whole AS (SELECT id, string_agg(CASE WHEN text <> chr(10) THEN ' ' || text END, '' ORDER BY pos) "
        "AS wt FROM conv GROUP BY id)",
    ]
    for stage in ("summary", "diarize"):
        d = STAGE_DEFAULTS[stage]
        m = f"model_{stage}"
        prompt = ("'summary'" if stage == "summary" else
                  "coalesce(prompt, CASE WHEN summary THEN 'diarize_w_summary' ELSE 'diarize_no_summary' END)")
        azure = f"azure_deployment_{stage}"
        ctes.append(
            f"{stage}_runs AS (SELECT *, CASE provider WHEN 'claude' THEN (CASE model {alias['claude']} END) WHEN 'llama' "
            f"THEN coalesce(llama_instance, CASE model {alias['llama']} END) WHEN 'azure' THEN {azure} END AS model_id "
            f"FROM (SELECT *, {m} AS model, {prompt} AS pname, CASE WHEN contains({m}, 'llama') THEN 'llama' "
            f"WHEN contains({m}, 'claude') THEN 'claude' WHEN contains({m}, 'azure') THEN 'azure' END AS provider, "
            f"CAST(coalesce(max_tokens_{stage}, {d['max_tokens']}) AS INTEGER) AS tokens, "
            f"CAST(coalesce(temperature_{stage}, {d['temperature']}) AS DOUBLE) AS temp, "
            f"CAST(coalesce(top_p_{stage}, {d['top_p']}) AS DOUBLE) AS top, "
            f"CAST(coalesce(do_sample_{stage}, {str(d['do_sample']).upper()}) AS BOOLEAN) AS sample FROM runs))")

    def stage_rows(stage: str, source: str, s: str, join: str = "", where: str = "") -> str:
        if stage == "summary":
            user = "c.text"
            azure = f"p.ptext || {nl2} || 'transcript: ' || {nl2} || c.text"
            lacking = "FALSE"
        else:
            user = (f"CASE WHEN r.summary THEN 'summary: ' || {s} || {nl2} || 'transcript: ' || c.text "
                    "ELSE 'transcript: ' || c.text END")
            azure = (f"CASE WHEN r.summary THEN p.ptext || {nl2} || 'summary:' || {s} || {nl2} || "
                     f"'transcript: ' || c.text ELSE p.ptext || {nl2} || 'transcript: ' || c.text END")
            lacking = f"r.summary AND {s} IS NULL"
        return (
            f"SELECT c.run_name, c.id, c.chunk, '{stage}' AS stage, r.provider, r.model_id, "
            "CASE WHEN r.provider IN ('claude', 'llama') THEN p.ptext END AS system_prompt, "
            f"CASE WHEN r.provider = 'azure' THEN {azure} WHEN r.provider IS NOT NULL THEN {user} END AS user_content, "
            "CAST(CASE r.provider WHEN 'llama' THEN 2 WHEN 'claude' THEN 1 WHEN 'azure' THEN 1 END AS INTEGER) AS n_messages, "
            "r.tokens AS max_tokens, r.temp AS temperature, CASE WHEN r.provider <> 'claude' THEN r.top END AS top_p, "
            "CASE WHEN r.provider = 'llama' THEN r.sample END AS do_sample, "
            "CASE WHEN r.provider = 'azure' THEN CAST(0 AS DOUBLE) END AS frequency_penalty, "
            "CASE WHEN r.provider = 'azure' THEN CAST(0 AS DOUBLE) END AS presence_penalty, "
            "CASE WHEN r.provider IS NULL THEN 'unknown model' WHEN r.model_id IS NULL THEN 'no model id' "
            f"WHEN p.ptext IS NULL THEN 'no prompt' WHEN {lacking} THEN 'no summary' END AS problem "
            f"FROM {source} c JOIN {stage}_runs r USING (run_name) LEFT JOIN prompts p ON p.prompt_name = r.pname {join} {where}")

    if summary_mode == "per_chunk":
        return with_(ctes, stage_rows("summary", "chunks", "NULL", where="WHERE r.summary") + " UNION ALL "
                     + stage_rows("diarize", "chunks", "CASE WHEN r.run_name <> 'r5' THEN c.text END"))
    return with_(ctes, stage_rows("summary", "joined", "NULL", where="WHERE r.summary") + " UNION ALL "
                 + stage_rows("diarize", "chunks", "w.wt", "LEFT JOIN whole w ON w.id = c.id", "WHERE r.summary"))


def given_ctes() -> list[str]:
    names = ", ".join(f"({q(name)}, {q(RUNS[k % len(RUNS)].run_name)})" for k, name in enumerate(GIVEN_RUNS))
    return scored_sql()[0] + diff_scores_ctes() + [
        "sizes AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(sum(length(text)) AS BIGINT) AS c "
        "FROM conversations GROUP BY 1)",
        f"given_names(name, simulated) AS (VALUES {names})",
        "given AS (SELECT g.name AS run_name, s.* EXCLUDE (run_name) FROM all_scores s JOIN sizes USING (id) "
        "JOIN given_names g ON g.simulated = s.run_name WHERE s.segment < 2 OR c % 7 <> 0)",
    ]


GIVEN_COLUMNS = ("lev_acc", "lev_acc_normed", "diff_acc", "diff_acc_normed", "composite", "composite_normed",
                 "lev_baseline", "diff_baseline")


def given_queries() -> dict[str, str]:
    means = ", ".join(f"round(avg({c}), 6) AS {c}" for c in GIVEN_COLUMNS)
    exact = ", ".join(f"avg({c}) AS {c}" for c in GIVEN_COLUMNS)
    per_run = f"means AS (SELECT run_name, count(*) AS n_rows, {exact} FROM given GROUP BY run_name)"
    chosen = lambda rows: ", ".join(f"({k}, {q(r)}, {q(label)})" for k, (r, label) in enumerate(rows))
    return {
        "composite_scores": with_(given_ctes(), "SELECT run_name, id, segment, "
                                  + ", ".join(f"round({c}, 6) + 0 AS {c}" for c in GIVEN_COLUMNS) + " FROM given"),
        "one_segment_means": with_(given_ctes(), f"SELECT run_name, count(*) AS n_rows, {means} FROM given "
                                   "WHERE segment = 0 AND contains(run_name, 'seg') GROUP BY run_name"),
        "compare_best": with_(
            given_ctes() + [per_run, f"sel(ord, run_name, label) AS (VALUES {chosen(CATALOGUE['best_of_each'])})"],
            "SELECT s.run_name, s.ord, s.label, m.n_rows, " + ", ".join(f"round(m.{c}, 6) AS {c}" for c in GIVEN_COLUMNS)
            + " FROM sel s JOIN means m USING (run_name)"),
        "compare_summary_overall": with_(
            given_ctes() + [per_run, "sel(ord, run_name, label) AS (VALUES "
                            + chosen(GROUP_CATALOGUE["summary_vs_none_overall"]) + ")"],
            "SELECT s.label, min(s.ord) AS ord, count(*) AS n_runs, "
            + ", ".join(f"round(avg(m.{c}), 6) AS {c}" for c in GIVEN_COLUMNS)
            + " FROM sel s JOIN means m USING (run_name) GROUP BY s.label"),
        "compare_catalogue": with_(
            given_ctes() + [per_run, "sel(selection, grouped, ord, run_name, label) AS (VALUES " + ", ".join(
                f"({q(name)}, {group}, {k}, {q(r)}, {q(label)})" for group, named in ((0, CATALOGUE), (1, GROUP_CATALOGUE))
                for name, rows in named.items() for k, (r, label) in enumerate(rows)) + ")"],
            "SELECT s.selection, s.label, min(s.ord) AS ord, count(*) AS n_runs, CAST(sum(m.n_rows) AS BIGINT) AS n_rows, "
            + ", ".join(f"round(avg(m.{c}), 6) + 0 AS {c}" for c in GIVEN_COLUMNS)
            + " FROM sel s JOIN means m USING (run_name) "
              "GROUP BY s.selection, s.label, CASE WHEN s.grouped = 0 THEN s.ord END"),
        "transcript_curves": with_(
            given_ctes(), "SELECT g.run_name, g.id, count(*) OVER (PARTITION BY g.run_name, g.id) = k.n AS complete, "
            "CAST(row_number() OVER (PARTITION BY g.run_name, g.id ORDER BY g.segment) - 1 AS INTEGER) AS ord, "
            "round(g.composite_normed, 6) + 0 AS value FROM given g JOIN (SELECT run_name, max(segment) + 1 AS n "
            "FROM given GROUP BY run_name) k USING (run_name)"),
        "parse_problems": with_(
            ["conv AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(conv_id % 5 AS INTEGER) AS kind, "
             "CAST(turn AS INTEGER) AS pos, text, count(*) OVER (PARTITION BY conv_id) AS n_rows FROM conversations)",
             f"cut AS (SELECT *, {seg('pos', 'n_rows', '2')} AS segment FROM conv WHERE kind > 2)",
             "agg AS (SELECT id, segment, string_agg(CASE WHEN text <> chr(10) THEN ' ' || text END, '' ORDER BY pos) "
             "AS t FROM cut GROUP BY ALL)"],
            "SELECT DISTINCT id, 'malformed' AS state, CAST(NULL AS INTEGER) AS segment, CAST(NULL AS VARCHAR) AS text "
            "FROM conv WHERE kind IN (1, 2) UNION ALL SELECT g.id, 'read' AS state, CAST(g.segment AS INTEGER) AS segment, "
            "coalesce(a.t, '') AS text FROM (SELECT id, unnest(range(2)) AS segment FROM (SELECT DISTINCT id FROM conv "
            "WHERE kind IN (0, 3, 4))) g LEFT JOIN agg a USING (id, segment)"),
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    counts = ("(SELECT CAST(conv_id AS VARCHAR) AS id, count(*) AS n_utterances FROM conversations GROUP BY 1)")
    out["transcript_ids"] = (f"SELECT CAST(l.doc_id AS VARCHAR) AS id, c.n_utterances FROM labels l "
                             f"JOIN {counts} c ON CAST(l.doc_id AS VARCHAR) = c.id")
    out["missing_transcripts"] = (f"SELECT CAST(l.doc_id AS VARCHAR) AS id FROM labels l "
                                  f"ANTI JOIN {counts} c ON CAST(l.doc_id AS VARCHAR) = c.id")
    out["utterances_from_json"] = (
        f"SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, "
        f"CAST(turn * {SECONDS_PER_TURN} AS DOUBLE) AS start_s, "
        f"CAST(turn * {SECONDS_PER_TURN} AS DOUBLE) + {SECONDS_PER_TURN} AS end_s, text, "
        "CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS n_rows FROM conversations")
    out["manifest_lookup"] = (
        "WITH m AS (SELECT page_id AS line_no, regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1) AS id, "
        "url AS path FROM pages), f AS (SELECT id, arg_min(path, line_no) AS path FROM m WHERE id <> '' "
        "GROUP BY id) SELECT CAST(d.doc_id AS VARCHAR) AS id, substr(f.path, 1, length(f.path) - 4) || '.json' "
        "AS json_path FROM documents d LEFT JOIN f ON CAST(d.doc_id AS VARCHAR) = f.id")
    out["lines_from_text"] = with_(
        ["docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, text AS value FROM documents)",
         lines_cte("dl", "docs", ["id"])], "SELECT id, pos, line, n_rows FROM dl")
    out["sentences_from_text"] = sentences_sql()
    out["flatten_transcript"] = with_(base_ctes()[:1] + raw_ctes(1, "never"),
                                      "SELECT r.id, coalesce(a.t, '') AS text, r.n_utterances FROM raw_seg r "
                                      "LEFT JOIN raw_agg a USING (id, segment)")
    chunk_nums = ", ".join(f"({n})" for n in CHUNK_COUNTS)
    out["chunk_transcript"] = with_([
        "conv AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, text FROM conversations)",
        f"cn(chunk_num) AS (VALUES {chunk_nums})",
        "n AS (SELECT id, count(*) AS n_rows FROM conv GROUP BY id)",
        f"rows AS (SELECT c.id, c.pos, c.text, cn.chunk_num, {seg('c.pos', 'n.n_rows', 'cn.chunk_num')} AS chunk "
        "FROM conv c JOIN n USING (id) CROSS JOIN cn)",
        "agg AS (SELECT chunk_num, id, chunk, string_agg(CASE WHEN text <> chr(10) THEN ' ' || text END, '' "
        "ORDER BY pos) AS t, count(*) AS n_utt FROM rows GROUP BY ALL)"],
        "SELECT CAST(g.chunk_num AS INTEGER) AS chunk_num, g.id, CAST(g.chunk AS INTEGER) AS chunk, "
        "coalesce(a.t, '') AS text, coalesce(a.n_utt, 0) AS n_utterances FROM (SELECT cn.chunk_num, n.id, "
        "unnest(range(cn.chunk_num)) AS chunk FROM n CROSS JOIN cn) g LEFT JOIN agg a USING (chunk_num, id, chunk)")
    heading = f"'chunk ' || CAST(chunk AS VARCHAR) || ':' || {lit(chr(10) * 2)}"
    out["raw_transcript_files"] = with_([
        "utts AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, "
        "CASE WHEN (conv_id + turn) % 4 = 1 THEN chr(10) ELSE text END AS text FROM conversations)",
        "n AS (SELECT id, count(*) AS n_rows FROM utts GROUP BY id)",
        f"rows AS (SELECT u.id, u.pos, u.text, {seg('u.pos', 'n.n_rows', '3')} AS chunk FROM utts u JOIN n USING (id))",
        "agg AS (SELECT id, chunk, string_agg(CASE WHEN text <> chr(10) THEN ' ' || text END, '' ORDER BY pos) AS t, "
        "count(*) AS c FROM rows GROUP BY ALL)",
        "grid AS (SELECT g.id, g.chunk, coalesce(t, '') AS t, coalesce(c, 0) AS c FROM (SELECT id, unnest(range(3)) AS chunk "
        "FROM n) g LEFT JOIN agg a USING (id, chunk))"],
        f"SELECT 'raw_' || id AS name, string_agg({heading} || t || {lit(chr(10) * 2)}, '' ORDER BY chunk) AS txt, "
        "'[' || string_agg(CAST(c AS VARCHAR), ', ' ORDER BY chunk) || ']' AS json_rows FROM grid GROUP BY id")
    out["chunked_json"] = with_([
        "conv AS (SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS INTEGER) AS pos, "
        f"CAST(turn * {SECONDS_PER_TURN} AS DOUBLE) AS start_s, CAST(turn * {SECONDS_PER_TURN} AS DOUBLE) + "
        f"{SECONDS_PER_TURN} AS end_s FROM conversations)",
        "cn(chunk_num) AS (VALUES (1), (3))",
        "n AS (SELECT id, count(*) AS n_rows FROM conv GROUP BY id)",
        f"rows AS (SELECT c.*, cn.chunk_num, {seg('c.pos', 'n.n_rows', 'cn.chunk_num')} AS chunk "
        "FROM conv c JOIN n USING (id) CROSS JOIN cn)",
        "agg AS (SELECT chunk_num, id, chunk, count(*) AS n_utterances, min(pos) AS first_pos, "
        "max(pos) AS last_pos, min(start_s) AS start_s, max(end_s) AS end_s FROM rows GROUP BY ALL)"],
        "SELECT CAST(g.chunk_num AS INTEGER) AS chunk_num, g.id, CAST(g.chunk AS INTEGER) AS chunk, "
        "CASE WHEN g.chunk_num > 1 THEN 'chunk ' || CAST(g.chunk AS VARCHAR) END AS chunk_key, "
        "coalesce(a.n_utterances, 0) AS n_utterances, a.first_pos, a.last_pos, a.start_s, a.end_s "
        "FROM (SELECT cn.chunk_num, n.id, unnest(range(cn.chunk_num)) AS chunk FROM n CROSS JOIN cn) g "
        "LEFT JOIN agg a USING (chunk_num, id, chunk)")
    out["strip_labels_text"] = with_(pred_ctes(N, "canonical", "txt", with_labelled=False),
                                     "SELECT run_name, id, segment, bare FROM pred_seg")
    out["strip_labels_json"] = with_(pred_ctes(N, "canonical", "json"),
                                     "SELECT run_name, id, segment, bare FROM pred_seg")
    out["parse_labelled"] = with_(
        base_ctes() + answer_ctes() + [pred_file_cte(), lines_cte("pred_lines", "pred_files", ["run_name", "id"])],
        "SELECT run_name, id, pos, CASE WHEN instr(line, ':') > 0 THEN substr(line, 1, instr(line, ':') - 1) END "
        f"AS label, CASE WHEN instr(line, ':') > 0 THEN {canon('substr(line, 1, instr(line, chr(58)) - 1)')} END "
        "AS speaker, CASE WHEN instr(line, ':') > 0 THEN substr(line, instr(line, ':') + 1) ELSE line END AS text "
        "FROM pred_lines")
    out["parse_answers"] = with_(base_ctes() + answer_ctes() + json_turn_ctes(),
                                 "SELECT run_name, id, chunk, block, speaker, text FROM jturns")
    out["consolidate_turns"] = with_(pred_ctes(N, "canonical", "txt", with_bare=False),
                                     "SELECT run_name, id, segment, labelled FROM pred_seg")
    out["consolidate_literal"] = with_(pred_ctes(N, "literal", "txt", with_bare=False),
                                       "SELECT run_name, id, segment, labelled FROM pred_seg")
    out["consolidate_json"] = with_(pred_ctes(N, "canonical", "json"),
                                    "SELECT run_name, id, segment, labelled, bare FROM pred_seg")
    out["render_transcript"] = with_(base_ctes() + answer_ctes() + [pred_file_cte()],
                                     "SELECT run_name || '_' || id AS name, value FROM pred_files")
    out["render_chunked"] = with_(base_ctes() + answer_ctes() + [pred_file_cte(chunked=True)],
                                  "SELECT run_name || '_' || id AS name, value FROM pred_files")
    out["preservation_lev"] = score_select(["lev_pres"], families=("preservation",))
    out["preservation_lev_literal"] = score_select(["lev_pres"], n=1, families=("preservation",),
                                                   raw_normalise="literal")
    out["nolabel_baseline_lev"] = score_select(["lev_baseline"], families=("accuracy",))
    acc_cols = ["lev_acc", "lev_baseline", "lev_acc_normed"]
    out["accuracy_lev"] = score_select(acc_cols, families=("accuracy",))
    out["accuracy_lev_literal"] = score_select(acc_cols, families=("accuracy",), mode="literal")
    out["scores_lev_by_turn"] = score_select(["lev_pres", "lev_acc", "lev_acc_normed", "lev_baseline"],
                                             segment_by="turn")
    token = "regexp_replace(line, '^[^ ]*', '') AS bare_piece"
    label = "' ' || CASE WHEN instr(line, ':') > 0 THEN substr(line, instr(line, ':') + 1) ELSE line END AS bare_piece"
    out["preservation_by_label"] = score_select(["lev_pres"], families=("preservation",),
                                                segment_by="turn").replace(token, label)
    out["accuracy_lev_json"] = score_select(["lev_pres", "lev_acc", "lev_acc_normed", "lev_baseline"],
                                            source="json")
    ctes, _ = scored_sql()
    ctes += diff_scores_ctes()
    diff_cols = ["diff_pres", "diff_acc", "diff_acc_normed", "diff_baseline"]
    every = ["lev_pres", "lev_acc", "lev_acc_normed", "lev_baseline", *diff_cols, "composite", "composite_normed"]
    out["sentence_utterances"] = (
        "SELECT id, pos, sentence AS text, CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS n_rows "
        f"FROM ({sentences_sql()})")
    out["diff_ratio_scores"] = with_(ctes, f"SELECT run_name, id, segment, {r6(diff_cols)} FROM diff_scores")
    out["score_table"] = with_(ctes, f"SELECT run_name, id, segment, {r6(every)} FROM all_scores")
    avgs = ", ".join(f"round(avg({c}), 6) AS {c}" for c in every)
    out["flagship_segment_means"] = with_(
        ctes + [f"m AS (SELECT run_name, segment, count(*) AS n_rows, {avgs} FROM all_scores GROUP BY run_name, segment)"],
        "SELECT run_name, segment, CAST(max(segment) OVER (PARTITION BY run_name) + 1 AS INTEGER) AS n_segments, "
        f"n_rows, {', '.join(every)} FROM m")
    ctes, _ = scored_sql()
    tall = " UNION ALL ".join(
        f"SELECT run_name || {q(SCORE_FILE_SUFFIX)} AS run_name, {q(fam)} AS family, {q(met)} AS metric, id, "
        f"segment, round({col}, 6) AS score FROM scores"
        for col, fam, met in [("lev_pres", "preservation", "levenshtein"), ("lev_acc", "accuracy", "levenshtein"),
                              ("lev_acc_normed", "accuracy", "levenshtein_baseline_normed"),
                              ("lev_baseline", "nolabel_baseline", "levenshtein")])
    out["decode_score_files"] = with_(ctes, f"SELECT * FROM ({tall}) WHERE contains(run_name, 'seg')")
    out["run_means"] = means_select(1, by_segment=False)
    out["segment_means"] = means_select(N, by_segment=True)
    ctes, _ = scored_sql(families=("accuracy",))
    out["segment_progression"] = with_(
        ctes, "SELECT run_name, id, segment, round(lev_acc_normed, 6) AS value, "
              "round(avg(lev_acc_normed) OVER (PARTITION BY run_name, segment), 6) AS mean_value, "
              "count(*) OVER (PARTITION BY run_name, id) = max(segment) OVER (PARTITION BY run_name) + 1 "
              "AS complete FROM scores")
    ctes, cols = scored_sql(n=1)
    avgs = ", ".join(f"avg(CASE WHEN isnan({c}) THEN NULL ELSE {c} END) AS {c}" for c in cols)
    means = f"means AS (SELECT run_name, count(*) AS n_rows, {avgs} FROM scores GROUP BY run_name)"
    out["compare_runs"] = with_(
        ctes + [means, f"sel(ord, run_name, label) AS (VALUES {selection_values(RUN_SELECTION)})"],
        f"SELECT s.run_name, s.ord, s.label, m.n_rows, {r6(cols, 'm')} FROM sel s JOIN means m USING (run_name)")
    out["compare_groups"] = with_(
        ctes + [means, f"sel(ord, run_name, label) AS (VALUES {selection_values(GROUP_SELECTION)})"],
        "SELECT s.label, min(s.ord) AS ord, count(*) AS n_runs, "
        + ", ".join(f"round(avg(m.{c}), 6) AS {c}" for c in cols)
        + " FROM sel s JOIN means m USING (run_name) GROUP BY s.label")
    out["compare_by_summary"] = with_(
        ctes + [means],
        "SELECT r.summary, count(*) AS n_runs, "
        + ", ".join(f"round(avg(m.{c}), 6) AS {c}" for c in cols)
        + " FROM means m JOIN runs r USING (run_name) GROUP BY r.summary")
    out["missing_runs"] = with_(
        base_ctes() + answer_ctes() + [pred_file_cte(),
                                       f"sel(ord, run_name, label) AS (VALUES {selection_values(CHECKED_SELECTION)})"],
        "SELECT s.run_name, s.ord, s.label FROM sel s ANTI JOIN (SELECT DISTINCT run_name FROM pred_files) p "
        "USING (run_name)")
    out["model_requests"] = requests_sql("per_chunk")
    out["summary_join"] = requests_sql("whole")
    return out | given_queries()
