"""The work items as DataFrame operators, grouped by family.

selection    newest / extreme row per key, cohort split, campaign purity,
             indicator drops, tagged stacking, list exclusion (W01 W02 W08 W24 W27 W38 W39)
sequence     skew-safe ordered lags (used by W03 W27 W35)
persistency  development flags, term history and characteristics, ultimate
             cancellations, status, rates, cohort rates, code transitions,
             reinstatements (W03-W08 W30 W35)
loss         cohort extraction, rollup, reclassification, running ratio,
             relativity, share of total, segment loss ratio, premium change,
             loss by source (W09-W15 W37 W40)
reconcile    allocation, allocation check, joined update, metric
             reconciliation, snapshot vs history counts (W16-W20)
segment      banding, row relativities, one-pass summaries (W21-W23)
campaign     campaign outcomes and billing buckets (W25 W26)
linkage      crosswalk, household credit flags, attribute mismatch, line
             stacking, quote funnel, rule enrichment, breakdowns (W28 W29 W33 W34 W36 W42 W43)
events       event cohorts and id-list normalisation (W31 W32)
maintenance  profiling, distinct counts, DDL/INSERT helpers, top-k, claim ingestion (W40 W41 W44)
"""
