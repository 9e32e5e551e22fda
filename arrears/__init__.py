"""Loan arrears analytics on Spark.

Payments are allocated to repayment schedules (per instalment reference or
first-in-first-out across a contract), lateness, arrears, totals and net
present value are derived per contract, schedules are generated from loan
tapes, contracts are classified by payment behaviour, and enrichment requests
are served as batch or Structured Streaming jobs.  Everything is expressed
with DataFrame expressions, windows, aggregates and joins.
"""

from arrears.config import Cutoff

__all__ = ["Cutoff"]
