"""DuckDB SQL for the registered queries.

Models are rebuilt in SQL from the same tables: by quantile buckets, by unrolling a
fixed number of variational updates, or by recursion until the fit comes to rest.
Nothing is subset; each statement runs over its whole table.
"""

from __future__ import annotations

from checks.fixtures import (
    CELL_COLUMNS,
    CHUNK_ROWS,
    DIRTY_SQL_DUCKDB,
    EXTREME_SQL_DUCKDB,
    FIT_TARGET,
    FIRST_ROWS,
    ITERATIONS,
    MIXED_SQL_DUCKDB,
    MODAL,
    MODAL_REVERSED,
    N_CHUNKS,
    PLAIN_PASSES,
    REDONE,
    SEED,
    SYNTH_FACTOR,
    TAIL_CUTS,
)

EPS = "0.005::DOUBLE"
MAX_ITER = 300
MISSING = "(-9999999)::DOUBLE"


def r6(sql: str, places: int = 6) -> str:
    return f"round({sql}, {places}) + 0.0::DOUBLE"


def clip(sql: str, bound: str = "0.99") -> str:
    return f"greatest(-{bound}::DOUBLE, least({bound}::DOUBLE, {sql}))"


def uniform(key: str, seed: int = SEED, purpose: str = "draw") -> str:
    part = f"coalesce(length({key}::VARCHAR)::VARCHAR || ':' || {key}::VARCHAR, '-')"
    text = f"md5(concat_ws('|', '{purpose}', '{seed}', {part}))"
    return f"(('0x' || substr({text}, 1, 8))::UBIGINT)::DOUBLE / 4294967296.0::DOUBLE"


def digamma(x: str) -> str:
    below = " + ".join(f"1.0::DOUBLE/(({x})+{i})" for i in range(8))
    y = f"(({x})+8.0::DOUBLE)"
    inv = f"(1.0::DOUBLE/({y}*{y}))"
    series = (
        f"{inv}*(1.0::DOUBLE/12 - {inv}*(1.0::DOUBLE/120 - {inv}*(1.0::DOUBLE/252"
        f" - {inv}*(1.0::DOUBLE/240 - {inv}/132.0::DOUBLE))))"
    )
    return f"(ln({y}) - 0.5::DOUBLE/{y} - {series} - ({below}))"


def with_(ctes: list[str], tail: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + tail


def cuts_ctes(p: str, cuts) -> list[str]:
    """{p}_hard(id, x, k): bucket by order statistics at per-mille ranks of {p}(id, x)."""
    ranks = " UNION ALL ".join(f"SELECT {c} AS pm" for c in cuts)
    return [
        f"{p}_n AS MATERIALIZED (SELECT count(*) AS n FROM {p})",
        f"{p}_rk AS (SELECT x, row_number() OVER (ORDER BY x) AS rn FROM {p})",
        f"{p}_cut AS MATERIALIZED (SELECT r.x AS cut FROM ({ranks}) c, {p}_n n, {p}_rk r"
        f" WHERE r.rn = greatest(1, (n.n * c.pm + 999) // 1000))",
        f"{p}_hard AS MATERIALIZED (SELECT s.id, s.x, "
        + "(SELECT count(*) FROM {0}_cut WHERE {0}_cut.cut < s.x)::INTEGER AS k FROM {0} s)".format(p),
    ]


def use_ctes(p: str) -> list[str]:
    """From {p} and {p}_base(k, weight, mean, std, c, h): posteriors and {p}_params."""
    return [
        f"{p}_z AS MATERIALIZED (SELECT s.id, s.x, b.k, b.c - b.h*(s.x-b.mean)*(s.x-b.mean) AS z FROM {p} s, {p}_base b)",
        f"{p}_e AS (SELECT id, x, k, z, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM {p}_z)",
        f"{p}_post AS MATERIALIZED (SELECT id, x, k, z, e / sum(e) OVER (PARTITION BY id) AS r,"
        f" row_number() OVER (PARTITION BY id ORDER BY z DESC, k) AS place FROM {p}_e)",
        f"{p}_use AS (SELECT k, sum(r) AS mass, count(*) FILTER (WHERE place = 1) AS hits FROM {p}_post GROUP BY k)",
        f"{p}_act AS (SELECT b.*, u.mass, u.hits, (b.weight > {EPS} AND u.hits > 0) AS active,"
        f" b.weight > {EPS} AS heavy FROM {p}_base b JOIN {p}_use u USING (k))",
        f"{p}_params AS MATERIALIZED (SELECT *, CASE WHEN active THEN (row_number() OVER (PARTITION BY active ORDER BY mass DESC, k) - 1)::INTEGER END AS rank FROM {p}_act)",
    ]


def bucket(p: str, source: str, cuts=TAIL_CUTS) -> list[str]:
    """{p}(id, x) and its bucket model."""
    return [
        f"{p} AS MATERIALIZED ({source})",
        *cuts_ctes(p, cuts),
        f"{p}_base AS MATERIALIZED (SELECT k, w AS weight, mean, std, ln(w) - 0.5::DOUBLE*ln(2*pi()) - ln(std) AS c, 0.5::DOUBLE/(std*std) AS h"
        f" FROM (SELECT h.k, count(*)::DOUBLE / any_value(n.n) AS w, avg(h.x) AS mean, greatest(stddev_pop(h.x), 0.001::DOUBLE) AS std"
        f" FROM {p}_hard h, {p}_n n GROUP BY h.k))",
        *use_ctes(p),
    ]


def variational(p: str, source: str, iterations: int, size: int = 10) -> list[str]:
    """{p}(id, x) and its variational fit after a fixed number of iterations."""
    cuts = [round(1000 * i / size) for i in range(1, size)]
    ctes = [
        f"{p} AS MATERIALIZED ({source})",
        *cuts_ctes(p, cuts),
        f"{p}_st AS MATERIALIZED (SELECT avg(x) AS mu, stddev_samp(x) AS sd, 0.000001::DOUBLE/var_samp(x) AS reg FROM {p})",
        f"{p}_modes AS (SELECT range::INTEGER AS k FROM range({size}))",
        f"{p}_std AS MATERIALIZED (SELECT s.id, (s.x - t.mu)/t.sd AS z FROM {p} s, {p}_st t)",
        f"{p}_r0 AS (SELECT h.k, (h.x - t.mu)/t.sd AS z, 1.0::DOUBLE AS r FROM {p}_hard h, {p}_st t)",
    ]
    for i in range(iterations + 1):
        ctes += [
            # Means first, spreads around them second.
            f"{p}_a{i} AS MATERIALIZED (SELECT m.k, coalesce(sum(r), 0) AS n, CASE WHEN sum(r) > 0 THEN sum(r*z)/sum(r) ELSE 0 END AS avg_z"
            f" FROM {p}_modes m LEFT JOIN {p}_r{i} r USING (k) GROUP BY m.k)",
            f"{p}_s{i} AS MATERIALIZED (SELECT a.k, any_value(a.n) AS n, any_value(a.avg_z) AS avg_z,"
            f" CASE WHEN any_value(a.n) > 0 THEN coalesce(sum(r.r*(r.z-a.avg_z)*(r.z-a.avg_z)), 0)/any_value(a.n) ELSE 0 END + any_value(t.reg) AS sk"
            f" FROM {p}_a{i} a CROSS JOIN {p}_st t LEFT JOIN {p}_r{i} r ON r.k = a.k GROUP BY a.k)",
            f"{p}_u{i} AS MATERIALIZED (SELECT k, n, 1+n AS a, 0.001::DOUBLE + coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS b,"
            f" 1+n AS beta, n*avg_z/(1+n) AS m, 1+n AS nu, (1 + n*sk + n/(1+n)*avg_z*avg_z)/(1+n) AS v FROM {p}_s{i})",
            f"{p}_d{i} AS MATERIALIZED (SELECT *, {digamma('a')} AS da, {digamma('b')} AS db, {digamma('a+b')} AS dab, {digamma('nu/2')} AS dnu FROM {p}_u{i})",
            f"{p}_p{i} AS MATERIALIZED (SELECT k, n, a, b, m, v, da - dab + coalesce(sum(db - dab) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
            f" + 0.5::DOUBLE*(dnu + ln(2.0::DOUBLE) - ln(nu) - ln(v)) - 0.5::DOUBLE*ln(2*pi()) - 0.5::DOUBLE/beta AS c, 0.5::DOUBLE/v AS h FROM {p}_d{i})",
        ]
        if i < iterations:
            ctes += [
                f"{p}_l{i + 1} AS (SELECT s.id, s.z, p.k, p.c - p.h*(s.z-p.m)*(s.z-p.m) AS l FROM {p}_std s, {p}_p{i} p)",
                f"{p}_x{i + 1} AS (SELECT id, z, k, exp(l - max(l) OVER (PARTITION BY id)) AS e FROM {p}_l{i + 1})",
                f"{p}_r{i + 1} AS MATERIALIZED (SELECT z, k, e / sum(e) OVER (PARTITION BY id) AS r FROM {p}_x{i + 1})",
            ]
    last = iterations
    ctes += [
        f"{p}_w AS (SELECT k, a/(a+b) * coalesce(exp(sum(ln(b/(a+b))) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS w FROM {p}_p{last})",
        f"{p}_base AS MATERIALIZED (SELECT p.k, w.w / (SELECT sum(w) FROM {p}_w) AS weight, p.m*t.sd + t.mu AS mean, sqrt(p.v)*t.sd AS std,"
        f" p.c - ln(t.sd) AS c, p.h/(t.sd*t.sd) AS h FROM {p}_p{last} p JOIN {p}_w w USING (k) CROSS JOIN {p}_st t)",
        *use_ctes(p),
    ]
    return ctes


def accelerated(
    p: str,
    source: str,
    size: int = 10,
    tol: str = "0.000001",
    every: int = 3,
    most: int = MAX_ITER,
) -> list[str]:
    """{p}(id, x) and its variational fit at default settings, by recursion: plain updates and,
    each third pass, one from an extrapolated point (never if ``every`` is 0), until the bound moves
    by less than ``tol`` per row or ``most`` passes are made.

    {p}_it holds the state after each pass, the two before it, and what steers the passes.
    """
    cuts = [round(1000 * i / size) for i in range(1, size)]
    later = "coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)"
    before = "OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    fresh = "n*avg_z/(1+n) AS m, (1 + n*sk + n/(1+n)*avg_z*avg_z)/(1+n) AS v"

    def turn(x):
        return f"({x}0 - 2*{x}1 + {x}2)"

    def on(x):
        return f"({x}2 + 2*len*({x}1 - {x}2) + len*len*{turn(x)})"

    def kernel(name, source, keep):
        return [
            f"{name}_u AS (SELECT k, n, m, v, 1+n AS a, 0.001::DOUBLE + {later} AS b FROM {source})",
            f"{name}_d AS (SELECT *, {digamma('a')} AS da, {digamma('b')} AS db, {digamma('a+b')} AS dab, {digamma('a/2')} AS dnu FROM {name}_u)",
            f"{name}_p AS {keep} (SELECT k, a, b, m, v, da - dab + coalesce(sum(db - dab) {before}, 0)"
            f" + 0.5::DOUBLE*(dnu + ln(2.0::DOUBLE) - ln(a) - ln(v)) - 0.5::DOUBLE*ln(2*pi()) - 0.5::DOUBLE/a AS c, 0.5::DOUBLE/v AS h FROM {name}_d)",
        ]

    one_pass = [
        f"cur AS MATERIALIZED (SELECT * FROM {p}_it WHERE NOT done AND i < {most})",
        "y AS MATERIALIZED (SELECT k, i, longest, n, m, v, sqrt(n/total) AS w0, sqrt(n1/total) AS w1, sqrt(n2/total) AS w2, m AS m0, m1, m2, ln(v) AS v0, ln(v1) AS v1, ln(v2) AS v2, total FROM cur)",
        f"z AS (SELECT any_value(i) AS i, any_value(longest) AS longest, sum((w1-w2)*{turn('w')} + (m1-m2)*{turn('m')} + (v1-v2)*{turn('v')}) AS rv, sum({turn('w')}**2 + {turn('m')}**2 + {turn('v')}**2) AS vv FROM y)",
        f"o AS MATERIALIZED (SELECT {'i > 0 AND i % 3 = 0' if every else 'false'} AS tried, longest, greatest(1, least(CASE WHEN vv > 0 THEN abs(rv)/vv ELSE 1 END, longest)) AS len FROM z)",
        f"e AS (SELECT k, tried, total, CASE WHEN tried THEN greatest({on('w')}, 0)**2 ELSE n END AS n, CASE WHEN tried THEN {on('m')} ELSE m END AS m, CASE WHEN tried THEN exp({on('v')}) ELSE v END AS v FROM y, o)",
        "t AS MATERIALIZED (SELECT k, CASE WHEN tried THEN n * total / sum(n) OVER () ELSE n END AS n, m, v FROM e)",
        *kernel("g", "t", "MATERIALIZED"),
        f"l AS (SELECT s.z, s.w, p.k, s.z - p.m AS d, p.c - p.h*(s.z-p.m)*(s.z-p.m) AS l FROM {p}_vals s, g_p p)",
        "x AS (SELECT *, max(l) OVER (PARTITION BY z) AS top FROM l)",
        "r AS (SELECT z, w, k, d, top, exp(l - top) AS e, sum(exp(l - top)) OVER (PARTITION BY z) AS norm FROM x)",
        "q AS (SELECT k, sum(w*e/norm) AS n, sum(w*e/norm*d) AS s1, sum(w*e/norm*d*d) AS s2, sum(CASE WHEN k = 0 THEN w*(top + ln(norm)) ELSE 0 END) AS ln FROM r GROUP BY k)",
        f"a AS (SELECT k, q.n, CASE WHEN q.n > 0 THEN p.m + q.s1/q.n ELSE 0 END AS avg_z, CASE WHEN q.n > 0 THEN greatest(q.s2/q.n - (q.s1/q.n)**2, 0) ELSE 0 END + t.reg AS sk, q.ln - (p.c*q.n - p.h*q.s2) AS part FROM q JOIN g_p p USING (k), {p}_st t)",
        f"f AS MATERIALIZED (SELECT k, n, {fresh}, part, 1+n AS a, 0.001::DOUBLE + {later} AS b FROM a)",
        "b AS (SELECT sum(part + a*(-0.5::DOUBLE*ln(v) - 0.5::DOUBLE*ln(a)) + a*0.5::DOUBLE*ln(2.0::DOUBLE) + lgamma(a/2) + lgamma(a) + lgamma(b) - lgamma(a+b) - 0.5::DOUBLE*ln(a)) AS bound FROM f)",
        f"j AS MATERIALIZED (SELECT tried, b.bound/c.total AS bound, NOT tried OR b.bound/c.total >= c.bound AS moved, NOT tried AND coalesce(abs(b.bound/c.total - c.bound) < {tol}, false) AS done,"
        " CASE WHEN NOT tried OR len < o.longest THEN o.longest WHEN b.bound/c.total >= c.bound THEN o.longest*4 ELSE greatest(4, o.longest/4) END AS longest"
        " FROM b, o, (SELECT any_value(bound) AS bound, any_value(total) AS total FROM cur) c)",
    ]
    step = (
        f"WITH {', '.join(one_pass)} SELECT c.i + 1, c.k, CASE WHEN j.moved THEN f.n ELSE c.n END, CASE WHEN j.moved THEN f.m ELSE c.m END, CASE WHEN j.moved THEN f.v ELSE c.v END,"
        " c.n, c.m, c.v, c.n1, c.m1, c.v1, CASE WHEN j.moved THEN j.bound ELSE c.bound END, j.done, j.longest, c.total FROM cur c JOIN f USING (k), j"
    )
    return [
        f"{p} AS MATERIALIZED ({source})",
        *cuts_ctes(p, cuts),
        f"{p}_st AS MATERIALIZED (SELECT avg(x) AS mu, stddev_samp(x) AS sd, 0.000001::DOUBLE/var_samp(x) AS reg, count(*)::DOUBLE AS total FROM {p})",
        f"{p}_vals AS MATERIALIZED (SELECT (s.x - t.mu)/t.sd AS z, count(*)::DOUBLE AS w FROM {p} s, {p}_st t GROUP BY 1)",
        f"{p}_h0 AS (SELECT h.k, count(*)::DOUBLE AS n, avg((h.x - t.mu)/t.sd) AS avg_z, var_pop((h.x - t.mu)/t.sd) + any_value(t.reg) AS sk FROM {p}_hard h, {p}_st t GROUP BY h.k)",
        f"{p}_h1 AS (SELECT m.range::INTEGER AS k, coalesce(h.n, 0)::DOUBLE AS n, coalesce(h.avg_z, 0) AS avg_z, coalesce(h.sk, t.reg) AS sk, t.total FROM range({size}) m CROSS JOIN {p}_st t LEFT JOIN {p}_h0 h ON h.k = m.range)",
        f"{p}_s0 AS MATERIALIZED (SELECT k, n, {fresh}, total FROM {p}_h1)",
        f"{p}_it(i, k, n, m, v, n1, m1, v1, n2, m2, v2, bound, done, longest, total) AS (SELECT 0, k, n, m, v, n, m, v, n, m, v, NULL::DOUBLE, false, 4.0::DOUBLE, total FROM {p}_s0 UNION ALL ({step}))",
        f"{p}_end AS MATERIALIZED (SELECT k, n, m, v FROM {p}_it WHERE i = (SELECT max(i) FROM {p}_it))",
        *kernel(f"{p}_end", f"{p}_end", "MATERIALIZED"),
        f"{p}_w AS (SELECT k, a/(a+b) * coalesce(exp(sum(ln(b/(a+b))) {before}), 1) AS w FROM {p}_end_p)",
        f"{p}_base AS MATERIALIZED (SELECT p.k, w.w / (SELECT sum(w) FROM {p}_w) AS weight, p.m*t.sd + t.mu AS mean, sqrt(p.v)*t.sd AS std,"
        f" p.c - ln(t.sd) AS c, p.h/(t.sd*t.sd) AS h FROM {p}_end_p p JOIN {p}_w w USING (k) CROSS JOIN {p}_st t)",
        *use_ctes(p),
    ]


def choice(p: str, mode_choice: str = "draw", seed: int = SEED) -> list[str]:
    """{p}_pick(id, x, k, rank, u): the chosen active mode of every row."""
    if mode_choice == "draw":
        chosen = [
            f"{p}_cum AS (SELECT q.id, q.x, q.k, sum(q.r + 0.000001::DOUBLE) OVER (PARTITION BY q.id ORDER BY q.k ROWS UNBOUNDED PRECEDING) AS cum,"
            f" sum(q.r + 0.000001::DOUBLE) OVER (PARTITION BY q.id) AS total FROM {p}_post q JOIN {p}_params m USING (k) WHERE m.active)",
            f"{p}_ch AS (SELECT id, any_value(x) AS x, coalesce(min(k) FILTER (WHERE cum > {uniform('id', seed)} * total), max(k)) AS k FROM {p}_cum GROUP BY id)",
        ]
    else:
        chosen = [
            f"{p}_ch AS (SELECT id, x, k FROM (SELECT q.id, q.x, q.k, row_number() OVER (PARTITION BY q.id ORDER BY q.z DESC, q.k) AS place"
            f" FROM {p}_post q JOIN {p}_params m USING (k) WHERE m.active) WHERE place = 1)"
        ]
    return [
        *chosen,
        f"{p}_pick AS MATERIALIZED (SELECT c.id, c.x, c.k, m.rank, m.mean, m.std, (c.x - m.mean)/(4*m.std) AS u FROM {p}_ch c JOIN {p}_params m USING (k))",
    ]


def hard_long(p: str, start: str = "0") -> str:
    """Rows (id, pos, value) of the hard block of {p}_pick."""
    return (
        f"SELECT id, ({start})::INTEGER AS pos, {r6(clip('u'))} AS value FROM {p}_pick"
        f" UNION ALL SELECT c.id, ({start} + 1 + m.rank)::INTEGER, CASE WHEN m.rank = c.rank THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        f" FROM {p}_pick c, {p}_params m WHERE m.active"
    )


def mixed(p: str, source: str, modal, models, mode_choice="draw", seed: int = SEED) -> list[str]:
    """A mixed column: overall model {p}a, model {p}c of ordinary rows, {p}_mixed(id, x, place, u, slot)."""
    special = ", ".join(f"{v!r}::DOUBLE" for v in modal)
    values = " UNION ALL ".join(f"SELECT {i} AS place, {v!r}::DOUBLE AS v" for i, v in enumerate(modal))
    n = len(modal)
    return [
        *models(f"{p}a", source),
        *models(f"{p}c", f"SELECT id, x FROM {p}a WHERE x NOT IN ({special})"),
        *choice(f"{p}c", mode_choice, seed),
        f"{p}_modal AS MATERIALIZED (SELECT l.place, l.v, CASE WHEN l.v = {MISSING} THEN 0.0::DOUBLE ELSE (SELECT {clip('(l.v - m.mean)/(4*m.std)')} FROM {p}a_params m ORDER BY abs(l.v - m.mean), m.k LIMIT 1) END AS u,"
        f" (SELECT count(*) FROM {p}a s WHERE s.x = l.v)::DOUBLE AS mass FROM ({values}) l)",
        f"{p}_idx AS (SELECT k, mean, std, mass, ({n} + row_number() OVER (ORDER BY k) - 1)::INTEGER AS place FROM {p}c_params WHERE active)",
        f"{p}_slots AS MATERIALIZED (SELECT place, (row_number() OVER (ORDER BY mass DESC, place) - 1)::INTEGER AS slot FROM (SELECT place, mass FROM {p}_modal UNION ALL SELECT place, mass FROM {p}_idx))",
        f"{p}_mixed AS MATERIALIZED (SELECT r.id, r.x, r.place, r.u, s.slot, r.back FROM ("
        f"SELECT a.id, a.x, l.place, l.u, l.v AS back FROM {p}a a JOIN {p}_modal l ON a.x = l.v"
        f" UNION ALL SELECT c.id, c.x, i.place, c.u, c.u*4*i.std + i.mean FROM {p}c_pick c JOIN {p}_idx i USING (k)) r JOIN {p}_slots s USING (place))",
    ]


def mixed_long(p: str, start: str = "0") -> str:
    return (
        f"SELECT id, ({start})::INTEGER AS pos, {r6(clip('u'))} AS value FROM {p}_mixed"
        f" UNION ALL SELECT r.id, ({start} + 1 + s.slot)::INTEGER, CASE WHEN s.slot = r.slot THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM {p}_mixed r, {p}_slots s"
    )


def dictionary(p: str, source: str) -> list[str]:
    """{p}_dict(idx, label, cnt) of a (label) source."""
    return [
        f"{p}_dict AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY cnt DESC, label) - 1)::BIGINT AS idx, label, cnt FROM"
        f" (SELECT label, count(*) AS cnt FROM ({source}) WHERE label IS NOT NULL GROUP BY label))"
    ]


EVENTS = "SELECT event_id AS id, value AS x FROM events"
MIXED = f"SELECT event_id AS id, {MIXED_SQL_DUCKDB} AS x FROM events"
EXTREME = f"SELECT event_id AS id, {EXTREME_SQL_DUCKDB} AS x FROM events"
DIRTY = f"SELECT id, x FROM (SELECT event_id AS id, {DIRTY_SQL_DUCKDB} AS x FROM events) WHERE x IS NOT NULL AND NOT isnan(x)"
CHANGED = (
    "SELECT event_id AS id, CASE WHEN event_id // 1000 = {} THEN value * 2 ELSE value END AS x FROM events"
)
ORDERS = "SELECT o_orderkey AS id, o_totalprice AS x FROM orders"
LINE = "SELECT row_number() OVER () AS id, {} AS x FROM lineitem"

EV = bucket("m", EVENTS)
PCTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def params_of(p: str, name: str, places: int, loose: bool = False) -> str:
    """``loose`` is for extrapolated passes, which carry the last digits of sums on."""
    weight, mass = (4, 1) if loose else (6, 3)
    return (
        f"SELECT '{name}' AS col, k, {r6('weight', weight)} AS weight, {r6('mean', places)} AS mean, {r6('std', places)} AS std,"
        f" {r6('mass', mass)} AS mass, hits::BIGINT AS hits, active, rank FROM {p}_params"
    )


def profile(source: str, name: str, pcts=PCTS, places: int = 6) -> str:
    quantiles = ", ".join(f"{r6(f'quantile_cont(x, {q})', places)} AS {n}" for n, q in pcts.items())
    return (
        f"SELECT '{name}' AS col, count(*) AS rows, {r6('min(x)', places)} AS min, {r6('max(x)', places)} AS max,"
        f" {r6('avg(x)', places)} AS mean, {r6('stddev_samp(x)', places)} AS std, {quantiles} FROM ({source})"
    )


def knots() -> str:
    return (
        "pr AS MATERIALIZED (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, "
        + ", ".join(f"quantile_cont(value, {q}) AS {n}" for n, q in PCTS.items())
        + " FROM events)"
    )


def piecewise(pieces) -> str:
    """CASE over (from, to, low, high) pieces of the uniform u."""
    whens = []
    for i, (start, stop, low, high) in enumerate(pieces):
        body = f"{low} + (u - {start!r}::DOUBLE)/({stop!r}::DOUBLE - {start!r}::DOUBLE)*({high} - {low})"
        whens.append(f"ELSE {body}" if i == len(pieces) - 1 else f"WHEN u < {stop!r}::DOUBLE THEN {body}")
    return "CASE " + " ".join(whens) + " END"


def synth_sql(pieces) -> str:
    return with_(
        [
            knots(),
            f"ids AS (SELECT r.range AS id FROM range((SELECT (n * {SYNTH_FACTOR})::BIGINT FROM pr)) r)",
            f"us AS (SELECT id, {uniform('id', purpose='synth')} AS u FROM ids)",
        ],
        f"SELECT id, {r6(piecewise(pieces))} AS amount FROM us, pr",
    )


def roundtrip_sql(source: str, decoded: str, clipped: str) -> str:
    ctes = [
        *bucket("m", source),
        *choice("m"),
        f"rt AS MATERIALIZED (SELECT id, x, abs({decoded} - x) AS err, ({clipped})::BIGINT AS clipped FROM m_pick)",
        "o AS (SELECT *, row_number() OVER (ORDER BY x) AS rn, count(*) OVER () AS n FROM rt)",
        "cuts AS MATERIALIZED (SELECT p.i, o.x AS cut FROM (SELECT range AS i FROM range(1, 10)) p, o WHERE o.rn = greatest(1, (o.n * p.i * 100 + 999) // 1000))",
        "tails AS MATERIALIZED (SELECT max(x) FILTER (WHERE rn = greatest(1, (n + 999) // 1000)) AS lo, max(x) FILTER (WHERE rn = n - greatest(1, (n + 999) // 1000) + 1) AS hi FROM o)",
        "g AS (SELECT rt.*, 1 + (SELECT count(*) FROM cuts WHERE cuts.cut < rt.x) AS d, (err <= 0.000000001::DOUBLE * greatest(1, abs(rt.x)))::BIGINT AS exact FROM rt)",
        "p AS (SELECT 'all' AS part, * FROM g UNION ALL SELECT 'decile_' || lpad(d::VARCHAR, 2, '0'), * FROM g"
        " UNION ALL SELECT 'bottom_tail', g.* FROM g, tails WHERE g.x <= tails.lo UNION ALL SELECT 'top_tail', g.* FROM g, tails WHERE g.x >= tails.hi)",
    ]
    return with_(
        ctes,
        f"SELECT part, count(*) AS rows, sum(clipped)::BIGINT AS clipped, sum(exact)::BIGINT AS exact, {r6('max(err)')} AS max_error, {r6('avg(err)')} AS mean_error FROM p GROUP BY part",
    )


def table_ctes(mode_choice: str = "draw") -> list[str]:
    """The three-column table: value (seed), mixed_value (seed + 1), event_type."""
    return [
        *bucket("v", EVENTS),
        *choice("v", mode_choice, SEED),
        *mixed("x", MIXED, MODAL, bucket, mode_choice, SEED + 1),
        *dictionary("t", "SELECT event_type AS label FROM events"),
        "wv AS (SELECT 1 + count(*) AS w FROM v_params WHERE active)",
        "wx AS (SELECT 1 + count(*) AS w FROM x_slots)",
    ]


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sources, filters, samples
    sql["scan_project"] = "SELECT event_id, value FROM events"
    sql["query_scan"] = (
        f"SELECT user_id, count(*) AS n, {r6('max(value)')} AS top FROM events GROUP BY user_id"
    )
    sql["connector_scan"] = (
        "SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key, "
        f"{r6('max(o_totalprice)')} AS top FROM orders WHERE o_orderstatus = 'F' "
        "GROUP BY o_orderpriority"
    )
    sql["csv_sample"] = f"SELECT o_orderkey, {r6('o_totalprice')} AS amount FROM orders"
    chunk = f"count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id, {r6('sum(value)', 4)} AS total"
    sql["chunk_range"] = (
        f"SELECT (event_id // {CHUNK_ROWS})::BIGINT AS chunk, {chunk} FROM events GROUP BY 1"
    )
    sql["chunk_mod"] = f"SELECT (event_id % {N_CHUNKS})::BIGINT AS chunk, {chunk} FROM events GROUP BY 1"
    sql["first_chunk"] = f"SELECT event_id, value FROM events ORDER BY event_id LIMIT {FIRST_ROWS}"
    sql["fit_sample"] = (
        f"SELECT event_id, value FROM events, (SELECT count(*) AS n FROM events) c"
        f" WHERE {uniform('event_id', purpose='sample')} < least(1.0::DOUBLE, {FIT_TARGET}.0::DOUBLE / c.n)"
    )
    sql["chunk_filter_query"] = (
        "SELECT CASE WHEN id < 0 THEN -2 ELSE 1 END::BIGINT AS chunk, count(*) AS rows, min(id) AS first_id,"
        f" max(id) AS last_id, {r6('sum(value)', 4)} AS total"
        " FROM (SELECT (event_id - 5000) * 9007199254741 AS id, event_id - 5000 AS n, value FROM events)"
        " WHERE n BETWEEN -2000 AND -1001 OR n BETWEEN 1000 AND 1999 GROUP BY 1"
    )
    sql["table_scan_sink"] = "SELECT o_orderkey, o_totalprice FROM orders"
    sql["merge_stage_tables"] = 'SELECT o_orderkey, o_orderstatus, 0 AS "left" FROM orders'
    sql["generate_count"] = (
        f"SELECT run::INTEGER AS run, n * {SYNTH_FACTOR} - run AS expected, n * {SYNTH_FACTOR} AS written"
        " FROM (SELECT count(*) AS n FROM events WHERE value IS NOT NULL), (SELECT unnest([0, 1]) AS run)"
    )
    sql["encode_job_report"] = (
        f"WITH d AS (SELECT {DIRTY_SQL_DUCKDB} AS v, event_type FROM events)"
        " SELECT 'dirty_value' AS col, true AS present, count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS nulls,"
        " count(*) FILTER (WHERE isnan(v)) AS nans, 0::BIGINT AS empties FROM d"
        " UNION ALL SELECT 'event_type', true, count(*), count(*) FILTER (WHERE event_type IS NULL), 0, count(*) FILTER (WHERE event_type = '') FROM d"
    )
    sql["sketched_profile"] = (
        f"SELECT 'value' AS col, count(*) AS rows, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std,"
        " min(value) AS min, max(value) AS max, true AS within FROM events"
    )
    sql["encode_job_saved"] = sql["encode_job_report"]
    sql["sample_folders"] = (
        f"SELECT * FROM (SELECT (event_id % {N_CHUNKS} + {N_CHUNKS}) % {N_CHUNKS} AS chunk, event_id, value FROM events)"
        f" WHERE {uniform('chunk', purpose='sample')} < 0.5"
    )
    sql["encode_keys"] = with_(
        dictionary("a", "SELECT l_partkey::VARCHAR AS label FROM lineitem"),
        "SELECT label::BIGINT AS l_partkey, idx, 1::BIGINT AS slots, cnt AS same FROM a_dict",
    )
    sql["mixed_split"] = (
        f"SELECT CASE WHEN x = 0 THEN 'zero' WHEN x = {MISSING} THEN 'missing' ELSE 'ordinary' END AS part,"
        f" count(*) AS rows, {r6('avg(x)')} AS mean FROM ({MIXED}) GROUP BY 1"
    )

    # Quality and profiles
    sql["quality_report"] = (
        f"WITH d AS (SELECT {DIRTY_SQL_DUCKDB} AS v, event_type FROM events)"
        " SELECT 'dirty_value' AS col, true AS present, count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS nulls,"
        " count(*) FILTER (WHERE isnan(v)) AS nans, 0::BIGINT AS empties FROM d"
        " UNION ALL SELECT 'event_type', true, count(*), count(*) FILTER (WHERE event_type IS NULL), 0, count(*) FILTER (WHERE event_type = '') FROM d"
        " UNION ALL SELECT 'amount', false, NULL, NULL, NULL, NULL"
    )
    sql["column_profile"] = profile("SELECT value AS x FROM events", "value")
    sql["column_profile_lineitem"] = " UNION ALL ".join(
        profile(f"SELECT {c} AS x FROM lineitem", c, places=4)
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    sql["column_profile_customer"] = profile("SELECT c_acctbal AS x FROM customer", "c_acctbal")

    # Dictionaries
    both = [
        *dictionary("a", "SELECT o_orderpriority AS label FROM orders"),
        *dictionary("b", "SELECT o_orderstatus AS label FROM orders"),
    ]
    sql["category_dict"] = with_(
        both,
        "SELECT 'o_orderpriority' AS col, idx, label, cnt FROM a_dict UNION ALL SELECT 'o_orderstatus', idx, label, cnt FROM b_dict",
    )
    sql["category_dict_keys"] = with_(
        dictionary("a", "SELECT l_partkey::VARCHAR AS label FROM lineitem"),
        "SELECT 'l_partkey' AS col, idx, label, cnt FROM a_dict",
    )
    sql["category_dict_grown"] = with_(
        [
            *dictionary("a", "SELECT l_partkey::VARCHAR AS label FROM lineitem WHERE l_linenumber = 1"),
            "n AS (SELECT l_partkey::VARCHAR AS label, count(*) AS cnt FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1)",
        ],
        "SELECT 'l_partkey' AS col, a.idx, a.label, a.cnt + coalesce(n.cnt, 0) AS cnt, 1 AS since FROM a_dict a LEFT JOIN n USING (label)"
        " UNION ALL SELECT 'l_partkey', (SELECT count(*) FROM a_dict) + row_number() OVER (ORDER BY cnt DESC, label) - 1, label, cnt, 2"
        " FROM n WHERE label NOT IN (SELECT label FROM a_dict)",
    )
    sql["categorical_index"] = with_(
        both, "SELECT o_orderkey, d.idx FROM orders JOIN a_dict d ON d.label = o_orderpriority"
    )
    sql["encode_categorical"] = with_(
        dictionary("t", "SELECT event_type AS label FROM events"),
        "SELECT event_id, s.idx::INTEGER AS pos, CASE WHEN s.idx = d.idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value"
        " FROM events JOIN t_dict d ON d.label = event_type, t_dict s",
    )
    sql["categorical_decode"] = "SELECT event_id, event_type AS decoded FROM events"

    # Scalar and mode functions
    sql["normalise"] = with_(
        EV,
        f"SELECT s.id AS event_id, p.k, {r6('(s.x-p.mean)/(4*p.std)')} AS u, {r6(clip('(s.x-p.mean)/(4*p.std)'))} AS clipped FROM m s, m_params p",
    )
    sql["posterior"] = with_(EV, f"SELECT id AS event_id, k, {r6('r')} AS r FROM m_post")
    sql["mode_draw"] = with_(
        [*EV, *choice("m")],
        f"SELECT id AS event_id, k AS mode, {r6(uniform('id'), 9)} AS uniform FROM m_pick",
    )
    sql["encode_sampled"] = with_(
        [*EV, *choice("m")],
        f"SELECT id AS event_id, k AS mode, {r6(uniform('id'), 9)} AS uniform FROM m_pick"
        f" WHERE {uniform('id', purpose='sample')} < 0.25::DOUBLE",
    )
    sql["modes_used"] = with_(EV, "SELECT k, hits::BIGINT AS hits FROM m_params WHERE hits > 0")
    sql["mode_mass"] = with_(EV, f"SELECT k, {r6('mass')} AS mass FROM m_params")
    sql["mode_order"] = with_(EV, f"SELECT k, {r6('mass')} AS mass, rank FROM m_params WHERE active")
    sql["active_components"] = with_(
        EV, f"SELECT k, {r6('weight')} AS weight, hits::BIGINT AS hits, active FROM m_params"
    )
    sql["reorder_roundtrip"] = with_(
        EV,
        f"SELECT a.id AS event_id, p.rank AS pos, {r6('a.r')} AS reordered, p.k AS mode, {r6('a.r')} AS restored FROM m_post a JOIN m_params p USING (k) WHERE p.active",
    )

    # Fits
    sql["em_sums"] = with_(
        EV,
        f"SELECT k, {r6('sum(r)')} AS n, {r6('sum(r*x)', 4)} AS sum_x, {r6('sum(r*x*x)', 3)} AS sum_xx FROM m_post GROUP BY k",
    )
    sql["em_step"] = with_(variational("m", EVENTS, 1), params_of("m", "value", 6))
    sql["fit_converged"] = with_(
        accelerated("m", ORDERS), params_of("m", "o_totalprice", 0, loose=True)
    )
    sql["fit_params"] = with_(
        accelerated("m", EVENTS, every=0, most=PLAIN_PASSES), params_of("m", "value", 5)
    )
    sql["fit_params_lineitem"] = with_(
        [
            *accelerated("a", LINE.format("l_extendedprice")),
            *accelerated("b", LINE.format("l_quantity")),
        ],
        params_of("a", "l_extendedprice", 0, loose=True) + " UNION ALL " + params_of("b", "l_quantity", 2, loose=True),
    )
    sql["refit_chunk"] = with_(
        accelerated("m", CHANGED.format(REDONE)), params_of("m", "value", 2, loose=True)
    )
    sql["cell_moments"] = " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) AS rows, {r6(f'avg({c})')} AS mean, {r6(f'var_samp({c})', 2)} AS var,"
        f" min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem"
        for c in CELL_COLUMNS
    )
    def plain(p, source):
        return accelerated(p, source, tol="0.00001", every=0)

    sql["fit_mixed"] = with_(
        mixed("x", MIXED, MODAL, plain),
        params_of("xa", "all rows", 0, loose=True) + " UNION ALL " + params_of("xc", "ordinary rows", 1, loose=True),
    )
    sql["mixed_slots"] = with_(
        mixed("x", MIXED, MODAL, plain), "SELECT place, slot FROM x_slots"
    )
    sql["encoder_layout"] = with_(
        table_ctes(),
        "SELECT 'value' AS col, 'continuous' AS kind, 0 AS block, 0 AS start, 1 AS width, 'tanh' AS activation, (SELECT min(x) FROM v) AS min, (SELECT max(x) FROM v) AS max"
        " UNION ALL SELECT 'value', 'continuous', 1, 1, (w - 1)::INTEGER, 'softmax', (SELECT min(x) FROM v), (SELECT max(x) FROM v) FROM wv"
        " UNION ALL SELECT 'mixed_value', 'mixed', 2, wv.w::INTEGER, 1, 'tanh', (SELECT min(x) FROM xa), (SELECT max(x) FROM xa) FROM wv"
        " UNION ALL SELECT 'mixed_value', 'mixed', 3, (wv.w + 1)::INTEGER, (wx.w - 1)::INTEGER, 'softmax', (SELECT min(x) FROM xa), (SELECT max(x) FROM xa) FROM wv, wx"
        " UNION ALL SELECT 'event_type', 'categorical', 4, (wv.w + wx.w)::INTEGER, (SELECT count(*) FROM t_dict)::INTEGER, 'softmax', NULL, NULL FROM wv, wx",
    )

    # Encoders
    def soft(where, u, pos):
        return (
            f"SELECT s.id AS event_id, 0 AS pos, {r6(u)} AS value FROM m s, (SELECT * FROM m_params WHERE {where} LIMIT 1) p"
            f" UNION ALL SELECT q.id, ({pos})::INTEGER, {r6('q.r')} FROM m_post q JOIN (SELECT *, row_number() OVER (ORDER BY k) AS nth FROM m_params WHERE {{keep}}) p USING (k)"
        )

    u = "(s.x - p.mean)/(4*p.std)"
    sql["encode_soft_full"] = with_(EV, soft("k = 0", u, "1 + q.k").format(keep="true"))
    first_heavy = "k = (SELECT min(k) FROM m_params WHERE heavy)"
    masked = soft(first_heavy, clip(u), "p.nth").format(keep="heavy")
    sql["encode_soft_masked"] = with_(EV, masked)
    sql["encode_soft_ordered"] = with_(EV, soft("k = 0", u, "1 + p.rank").format(keep="active"))
    for name, how, source in (
        ("encode_hard", "draw", EVENTS),
        ("encode_hard_argmax", "argmax", EVENTS),
        ("encode_extreme", "draw", EXTREME),
    ):
        sql[name] = with_(
            [*bucket("m", source), *choice("m", how)],
            f"SELECT l.id AS event_id, l.pos, l.value, {r6('CASE WHEN abs(c.u) > 0.99::DOUBLE THEN c.u END')} AS overflow FROM ({hard_long('m')}) l JOIN m_pick c USING (id)",
        )
    sql["encode_dirty"] = with_(
        [*bucket("m", DIRTY), *choice("m")],
        # least and greatest skip NULLs, so a row without a value is told apart first.
        f"SELECT e.event_id, CASE WHEN c.u IS NOT NULL THEN {r6(clip('c.u'))} END AS u, {r6('c.u*4*c.std + c.mean')} AS decoded FROM events e LEFT JOIN m_pick c ON c.id = e.event_id",
    )
    for name, modal in (("encode_mixed", MODAL), ("encode_mixed_reversed", MODAL_REVERSED)):
        sql[name] = with_(
            mixed("x", MIXED, modal, bucket),
            f"SELECT id AS event_id, pos, value FROM ({mixed_long('x')})",
        )
    sql["modal_norm"] = with_(
        mixed("x", MIXED, MODAL, bucket), f"SELECT v AS modal, {r6('u')} AS value FROM x_modal"
    )
    table_long = (
        f"{hard_long('v')} UNION ALL {mixed_long('x', '(SELECT w FROM wv)')}"
        " UNION ALL SELECT e.event_id, ((SELECT w FROM wv) + (SELECT w FROM wx) + s.idx)::INTEGER, CASE WHEN s.idx = d.idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        " FROM events e JOIN t_dict d ON d.label = e.event_type, t_dict s"
    )
    sql["encode_table"] = with_(
        table_ctes(), f"SELECT id AS event_id, pos, value FROM ({table_long})"
    )

    # Decoders
    sql["decode_continuous"] = with_(
        [*bucket("m", EXTREME), *choice("m")],
        f"SELECT id AS event_id, {r6('u*4*std + mean')} AS decoded, {r6(clip('u') + '*4*std + mean')} AS clipped FROM m_pick",
    )
    best = "(SELECT id, x, k FROM (SELECT q.*, row_number() OVER (PARTITION BY q.id ORDER BY q.r DESC, q.k) AS nth FROM m_post q JOIN m_params p USING (k) WHERE {}) WHERE nth = 1)"
    sql["decode_scores"] = with_(
        EV,
        f"SELECT b.id AS event_id, {r6(clip('(b.x - z.mean)/(4*z.std)', '1.0') + '*4*p.std + p.mean')} AS decoded"
        f" FROM {best.format('p.active')} b JOIN m_params p USING (k), (SELECT * FROM m_params WHERE k = 0) z",
    )
    sql["decode_soft_masked"] = with_(
        EV,
        f"SELECT b.id AS event_id, {r6(clip('(b.x - z.mean)/(4*z.std)') + '*4*p.std + p.mean')} AS decoded"
        f" FROM {best.format('p.heavy')} b JOIN m_params p USING (k), (SELECT * FROM m_params WHERE {first_heavy}) z",
    )
    sql["decode_mixed"] = with_(
        mixed("x", MIXED, MODAL, bucket), f"SELECT id AS event_id, {r6('back')} AS decoded FROM x_mixed"
    )
    sql["decode_table"] = (
        f"SELECT event_id, {r6('value')} AS decoded_value, {r6('x')} AS decoded_mixed_value, event_type AS decoded_event_type"
        f" FROM events JOIN ({MIXED}) ON id = event_id"
    )

    # Evaluation
    sql["encoding_stats"] = with_(
        [
            *EV,
            f"st AS MATERIALIZED (SELECT s.id, any_value({clip(u)}) AS v, max(q.r) AS top FROM m s JOIN m_post q USING (id) JOIN m_params k ON k.k = q.k AND k.heavy,"
            f" (SELECT * FROM m_params WHERE {first_heavy}) p GROUP BY s.id)",
        ],
        profile("SELECT v AS x FROM st", "value", {n: PCTS[n] for n in ("p25", "p50", "p75")})
        + " UNION ALL "
        + profile("SELECT top AS x FROM st", "confidence", {n: PCTS[n] for n in ("p25", "p50", "p75")}),
    )
    over = "CASE WHEN abs(u) > 0.99::DOUBLE THEN 1 ELSE 0 END"
    sql["roundtrip_report"] = roundtrip_sql(EXTREME, "(u*4*std + mean)", over)
    sql["roundtrip_clipped"] = roundtrip_sql(EXTREME, f"({clip('u')}*4*std + mean)", over)

    # Synthesis
    ends = [(0.0, "lo"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99"), (1.0, "hi")]
    sql["synth_amount"] = synth_sql([(a, b, x, y) for (a, x), (b, y) in zip(ends, ends[1:])])
    pieces, start, left = [], 0.0, 1.0
    for chance, low, high in ((0.25, "p25", "p50"), (0.75, "p50", "p75"), (0.9, "p75", "p90"), (0.95, "p90", "p95"), (1.0, "p95", "p99")):
        share = left * chance if chance < 1 else left
        pieces.append((start, start + share, low, high))
        start, left = start + share, left * (1 - chance)
    sql["synth_bracket"] = synth_sql(pieces)
    sql["synth_range"] = (
        f"SELECT (r.range // {CHUNK_ROWS})::BIGINT AS batch, count(*) AS rows, min(r.range) AS first_id, max(r.range) AS last_id"
        f" FROM range((SELECT count(*) * {SYNTH_FACTOR} FROM events)) r GROUP BY 1"
    )

    # Jobs
    encoded = f"{r6(clip('u'))} AS u, {r6('CASE WHEN abs(u) > 0.99::DOUBLE THEN u END')} AS overflow, rank AS slot"
    sql["encode_events"] = with_(
        [*variational("m", EVENTS, ITERATIONS), *choice("m")],
        f"SELECT id AS event_id, {encoded} FROM m_pick",
    )
    sql["encode_settled"] = with_(
        [*accelerated("m", EVENTS), *choice("m")],
        "SELECT rank AS slot, count(*) AS rows, round(avg(u), 3) AS mean_u FROM m_pick GROUP BY 1",
    )
    sql["encode_orders"] = with_(
        [*bucket("m", ORDERS), *choice("m")], f"SELECT id AS o_orderkey, {encoded} FROM m_pick"
    )
    sql["encode_chunks"] = with_(
        [*EV, *choice("m")],
        f"SELECT id AS event_id, (id // {CHUNK_ROWS})::BIGINT AS chunk, {encoded} FROM m_pick",
    )
    sql["merge_chunks"] = with_(
        [*EV, *choice("m")],
        f"SELECT (id % {N_CHUNKS})::BIGINT AS chunk, count(*) AS rows, {r6('sum(' + clip('u') + ')', 4)} AS total_u, count(*) FILTER (WHERE abs(u) > 0.99::DOUBLE) AS clipped FROM m_pick GROUP BY 1",
    )
    sql["encode_stream"] = with_(
        [*EV, *choice("m")], f"SELECT id AS event_id, {encoded} FROM m_pick"
    )
    return sql
