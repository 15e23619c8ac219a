"""logcube: daily app-activity reports (counts, users, growth, devices, funnels)
built from Spark DataFrame operators.

Every public function takes and returns DataFrames; nothing creates a session,
collects rows, or keeps global state.  The typical chain is::

    raw    = sources.raw_logs.read_raw_logs(spark, root, dates)      # S1/S2
    facts  = operators.events.parse_events(raw, kinds, tz="UTC")     # P1-P7, U1
    rich   = operators.enrich.enrich(facts, catalog, rule)           # J1, P11-P14
    cube   = operators.cube.rollup_counts(rich, keys, sets)          # A1-A8
    report = operators.growth.growth_report(cube, keys, names)       # J2, J3, R1

``plans.reports`` wires these into the report specs of the three families
(download / install / open) and ``plans.backfill`` runs any of them over a
date range in one pass.
"""

__version__ = "0.1.0"
