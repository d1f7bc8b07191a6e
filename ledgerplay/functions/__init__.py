"""Column-level formulas.

Most formulas are written once as SQL expression text so that the same
arithmetic runs in Spark (``F.expr``) and in any ANSI engine used to check
results.  Everything stays inside whole-stage codegen: no Python UDFs.
"""

from ledgerplay.functions.formulas import (  # noqa: F401
    norm_cdf,
    norm_cdf_sql,
    norm_pdf,
    norm_pdf_sql,
    norm_ppf,
    norm_sf,
    rnd,
    rnd_sql,
    unit_hash,
    unit_hash_sql,
    pmt,
    pmt_sql,
    annualize,
    deannualize,
)
