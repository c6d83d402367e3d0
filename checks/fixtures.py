"""Derived columns and fixed parameters shared by the queries and their SQL."""

SEED = 42
# Per-mille ranks of the bucket model: small first and last buckets, so that some modes
# fall below eps and masks and orders have something to do.
TAIL_CUTS = (4, 200, 400, 600, 750, 850, 920, 960, 997)
MODAL = (0.0, -9999999.0)
MODAL_REVERSED = (-9999999.0, 0.0)
N_CHUNKS = 20
CHUNK_ROWS = 1000
FIRST_ROWS = 4000
FIT_TARGET = 2500
# Passes of the plain updates that SQL unrolls.
ITERATIONS = 100
# Plain updates after which a fit is taken as it is; the test tables come to rest in 222 to 699.
PLAIN_PASSES = 3000
SYNTH_FACTOR = 5
# The chunk that is redone, and columns summarised in fewer cells than they have values.
REDONE = 3
CELL_COLUMNS = ("l_extendedprice", "l_quantity", "l_discount")

MIXED_SQL = (
    "CASE WHEN event_id % 10 = 0 THEN 0.0D WHEN event_id % 17 = 0 THEN -9999999.0D ELSE value END"
)
DIRTY_SQL = (
    "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 19 = 0 THEN double('NaN') ELSE value END"
)
EXTREME_SQL = "CASE WHEN event_id % 997 = 0 THEN value * 1000D ELSE value END"

MIXED_SQL_DUCKDB = (
    "CASE WHEN event_id % 10 = 0 THEN 0.0::DOUBLE"
    " WHEN event_id % 17 = 0 THEN (-9999999.0)::DOUBLE ELSE value END"
)
DIRTY_SQL_DUCKDB = (
    "CASE WHEN event_id % 13 = 0 THEN NULL"
    " WHEN event_id % 19 = 0 THEN 'NaN'::DOUBLE ELSE value END"
)
EXTREME_SQL_DUCKDB = "CASE WHEN event_id % 997 = 0 THEN value * 1000::DOUBLE ELSE value END"
