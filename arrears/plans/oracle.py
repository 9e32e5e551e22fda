"""DuckDB SQL oracles for the registered queries (same names, same column aliases).

They run on the driver's views (``lineitem``, ``orders`` …) and rebuild the
loan tables with the CTEs of :data:`arrears.sources.testdata.ORACLE_CTES`.
The oracles use the plain textbook forms (contract-wide windows, recursive
CTEs) on purpose: they are the independent statement of each rule.
"""

from __future__ import annotations

from arrears.sources.testdata import CALC_DATE, INVESTOR_RATE, ORACLE_CTES, SHARED_ORACLE_CTES

CALC = f"DATE '{CALC_DATE.isoformat()}'"
M = "DECIMAL(18,4)"

# Sanitised schedule (principal fallback), usable instalments and payments.
BASE = f"""WITH {ORACLE_CTES},
s AS (
  SELECT id, company_code, borrower_contract_id, borrower_installment_reference, installment_date, gross_amount,
         guarantee_amount,
         CASE WHEN guarantee_amount + principal_amount + interest_amount + tax_amount + fee_amount = 0
                   AND COALESCE(gross_amount, 0) > 0
              THEN gross_amount ELSE principal_amount END AS principal_amount,
         interest_amount, tax_amount, fee_amount
  FROM schedule
),
inst AS (
  SELECT *, GREATEST(guarantee_amount, 0) + GREATEST(principal_amount, 0) + GREATEST(interest_amount, 0)
            + GREATEST(tax_amount, 0) + GREATEST(fee_amount, 0) AS owed
  FROM s
  WHERE installment_date IS NOT NULL AND COALESCE(gross_amount, 0) > 0 AND borrower_contract_id IS NOT NULL
),
pv AS (SELECT * FROM payments WHERE payment_date IS NOT NULL AND COALESCE(total_payment, 0) > 0)"""


def _dpd(grace: int, calc: str = CALC) -> str:
    return f"GREATEST(CAST(date_diff('day', installment_date, {calc}) AS INTEGER) - {int(grace)}, 0)"


def cascade_ctes(grace=1, threshold="1.0", partial=False, calc=CALC, name="c") -> str:
    """CTE ``{name}``: usable instalments with applied_amount, dpd_current, amount_in_arrears."""
    paid = "applied_amount > 0" if partial else f"applied_amount >= gross_amount * CAST({threshold} AS DECIMAL(3,2))"
    return f""",
{name}_pool AS (SELECT borrower_contract_id, SUM(total_payment) AS pool FROM pv GROUP BY 1),
{name}_run AS (
  SELECT inst.*, COALESCE({name}_pool.pool, 0) AS pool,
         COALESCE(SUM(owed) OVER (PARTITION BY inst.borrower_contract_id ORDER BY installment_date, id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM inst LEFT JOIN {name}_pool USING (borrower_contract_id)
),
{name}_app AS (
  SELECT *, CAST(GREATEST(0, LEAST(owed, pool - before)) AS {M}) AS applied_amount FROM {name}_run
),
{name} AS (
  SELECT *,
         CAST(CASE WHEN {paid} THEN 0 ELSE {_dpd(grace, calc)} END AS INTEGER) AS dpd_current,
         CAST(CASE WHEN {paid} THEN 0 ELSE GREATEST(gross_amount - applied_amount, 0) END AS {M}) AS amount_in_arrears
  FROM {name}_app
)"""


def join_ctes(grace=1, threshold="1.0", calc=CALC, name="j") -> str:
    paid = f"paid_amount >= gross_amount * CAST({threshold} AS DECIMAL(3,2))"
    return f""",
{name}_ref AS (
  SELECT borrower_contract_id, borrower_installment_reference, SUM(total_payment) AS paid_amount
  FROM pv
  WHERE borrower_installment_reference IS NOT NULL AND trim(borrower_installment_reference) <> ''
  GROUP BY 1, 2
),
{name}_app AS (
  SELECT inst.*, CAST(COALESCE({name}_ref.paid_amount, 0) AS {M}) AS paid_amount
  FROM inst LEFT JOIN {name}_ref USING (borrower_contract_id, borrower_installment_reference)
),
{name} AS (
  SELECT *,
         CAST(CASE WHEN {paid} THEN 0 ELSE {_dpd(grace, calc)} END AS INTEGER) AS dpd_current,
         CAST(CASE WHEN {paid} THEN 0 ELSE GREATEST(gross_amount - paid_amount, 0) END AS {M}) AS amount_in_arrears
  FROM {name}_app
)"""


ALLOC_COLS = "borrower_contract_id, id, installment_date, gross_amount"

SQL: dict[str, str] = {}

SQL["scan_schedule"] = f"""WITH {ORACLE_CTES}
SELECT id, company_code, borrower_contract_id, borrower_installment_reference, installment_date, gross_amount,
       CAST(COALESCE(guarantee_amount, 0) AS {M}) AS guarantee_amount,
       CAST(COALESCE(principal_amount, 0) AS {M}) AS principal_amount,
       CAST(COALESCE(interest_amount, 0) AS {M}) AS interest_amount,
       CAST(COALESCE(tax_amount, 0) AS {M}) AS tax_amount,
       CAST(COALESCE(fee_amount, 0) AS {M}) AS fee_amount
FROM schedule WHERE company_code = 'BUILDING'"""

SQL["scan_payments"] = f"""WITH {ORACLE_CTES}
SELECT company_id, borrower_contract_id, borrower_installment_reference, payment_date, total_payment,
       MAX(payment_date) OVER (PARTITION BY company_id) AS last_payment_date
FROM payments
WHERE company_id = 2 AND payment_date IS NOT NULL AND total_payment > 0"""

SQL["scan_payments_all"] = f"""WITH {ORACLE_CTES}
SELECT company_id, borrower_contract_id, borrower_installment_reference, payment_date, total_payment,
       MAX(payment_date) OVER (PARTITION BY company_id) AS last_payment_date
FROM payments
WHERE payment_date IS NOT NULL AND total_payment > 0"""

SQL["dpd_cascade"] = BASE + cascade_ctes() + f"""
SELECT {ALLOC_COLS}, applied_amount, dpd_current, amount_in_arrears FROM c"""
SQL["dpd_cascade_partial"] = BASE + cascade_ctes(partial=True) + f"""
SELECT {ALLOC_COLS}, applied_amount, dpd_current, amount_in_arrears FROM c"""
SQL["dpd_cascade_threshold80"] = BASE + cascade_ctes(threshold="0.8") + f"""
SELECT {ALLOC_COLS}, applied_amount, dpd_current, amount_in_arrears FROM c"""
SQL["dpd_cascade_grace5"] = BASE + cascade_ctes(grace=5) + f"""
SELECT {ALLOC_COLS}, applied_amount, dpd_current, amount_in_arrears FROM c"""
SQL["dpd_join"] = BASE + join_ctes() + f"""
SELECT {ALLOC_COLS}, paid_amount, dpd_current, amount_in_arrears FROM j"""

# Components stand one after the other where the instalment begins on the contract's line of money.
_BUCKETS = ("guarantee", "principal", "interest", "tax", "fee")
SQL["cascade_components"] = BASE + cascade_ctes() + f"""
SELECT borrower_contract_id, id, applied_amount,
       {", ".join(f"CAST(GREATEST(0, LEAST(GREATEST({b}_amount, 0), pool - before - ({' + '.join(['0', *[f'GREATEST({x}_amount, 0)' for x in _BUCKETS[:i]]])}))) AS {M}) AS applied_{b}" for i, b in enumerate(_BUCKETS))}
FROM c"""

SQL["payments_by_ref"] = BASE + f"""
SELECT borrower_contract_id, borrower_installment_reference, CAST(SUM(total_payment) AS {M}) AS paid_amount
FROM pv
WHERE borrower_installment_reference IS NOT NULL AND trim(borrower_installment_reference) <> ''
GROUP BY 1, 2"""

LOAN_COLS = ("lt.borrower_contract_id, lt.company_code, lt.company_id, lt.original_principal, lt.num_installments, "
             "lt.interest_rate, lt.first_installment_date, lt.periodicity")

SQL["product_dpd"] = BASE + cascade_ctes() + f""",
f AS (
  SELECT borrower_contract_id, MAX(dpd_current) AS d,
         SUM(CASE WHEN dpd_current > 0 THEN amount_in_arrears END) AS arr
  FROM c GROUP BY 1
)
SELECT {LOAN_COLS},
       CAST(COALESCE(f.d, 0) AS INTEGER) AS dpd_current,
       CAST(COALESCE(f.d, 0) AS INTEGER) AS dpd_max,
       CAST(COALESCE(f.arr, 0) AS {M}) AS amount_in_arrears
FROM loan_tape lt LEFT JOIN f ON lt.borrower_contract_id = f.borrower_contract_id"""

SQL["product_total_amount"] = BASE + f""",
f AS (SELECT borrower_contract_id, SUM(total_payment) AS paid FROM payments WHERE total_payment > 0 GROUP BY 1)
SELECT {LOAN_COLS}, CAST(COALESCE(f.paid, 0) AS {M}) AS total_amount_paid
FROM loan_tape lt LEFT JOIN f ON lt.borrower_contract_id = f.borrower_contract_id"""


def _vpn_sql(rate) -> str:
    if rate:
        pv = (f"CAST(COALESCE(gross_amount, 0) AS DOUBLE) * (1.0 / pow(CAST({1.0 + rate!r} AS DOUBLE), "
              f"CAST(date_diff('day', {CALC}, installment_date) AS DOUBLE) / 365.25))")
    else:
        pv = "CAST(COALESCE(gross_amount, 0) AS DOUBLE)"
    return BASE + f""",
f AS (SELECT borrower_contract_id, SUM({pv}) AS pv FROM s WHERE installment_date > {CALC} GROUP BY 1)
SELECT {LOAN_COLS}, round(COALESCE(f.pv, 0.0), 2) AS vpn
FROM loan_tape lt LEFT JOIN f ON lt.borrower_contract_id = f.borrower_contract_id"""


SQL["product_vpn"] = _vpn_sql(INVESTOR_RATE)
SQL["product_vpn_zero_rate"] = _vpn_sql(None)

SCHED_COLS = ("s.id, s.company_code, s.borrower_contract_id, s.borrower_installment_reference, s.installment_date, "
              "s.gross_amount, s.guarantee_amount, s.principal_amount, s.interest_amount, s.tax_amount, s.fee_amount")

DETAIL = BASE + cascade_ctes() + join_ctes() + f""",
d AS (
  SELECT {SCHED_COLS},
         c.dpd_current AS cascade_dpd,
         CAST(CASE WHEN c.dpd_current = 0 THEN 0 ELSE c.amount_in_arrears END AS {M}) AS cascade_arrears,
         j.dpd_current AS join_dpd,
         CAST(CASE WHEN j.dpd_current = 0 THEN 0 ELSE j.amount_in_arrears END AS {M}) AS join_arrears
  FROM s
  LEFT JOIN c ON s.id = c.id AND s.borrower_contract_id = c.borrower_contract_id AND s.installment_date = c.installment_date
  LEFT JOIN j ON s.id = j.id AND s.borrower_contract_id = j.borrower_contract_id AND s.installment_date = j.installment_date
)"""

SQL["detail_both"] = DETAIL + """
SELECT d.*,
       MAX(cascade_dpd) OVER (PARTITION BY borrower_contract_id) AS max_cascade_dpd,
       MAX(join_dpd) OVER (PARTITION BY borrower_contract_id) AS max_join_dpd
FROM d"""

SQL["summary_both"] = DETAIL + f"""
SELECT borrower_contract_id,
       COUNT(id) AS cuotas,
       MAX(cascade_dpd) AS cascade_dpd_max,
       CAST(COALESCE(SUM(CASE WHEN cascade_dpd > 0 THEN cascade_arrears END), 0) AS {M}) AS cascade_arrears_total,
       MAX(join_dpd) AS join_dpd_max,
       CAST(COALESCE(SUM(CASE WHEN join_dpd > 0 THEN join_arrears END), 0) AS {M}) AS join_arrears_total
FROM d WHERE borrower_contract_id IS NOT NULL
GROUP BY borrower_contract_id"""


def _raw_date(column: str) -> str:
    """The text a date is delivered as, and what reading it month first gives."""
    return f"""CASE WHEN id % 97 = 0 THEN 'n/a' WHEN id % 89 = 0 THEN strftime({column}, '13/%d/%Y')
                WHEN id % 3 = 0 THEN strftime({column}, '%m/%d/%Y') ELSE strftime({column}, '%Y-%m-%d') END"""


def _read_date(text: str) -> str:
    return f"CAST(COALESCE(try_strptime({text}, '%Y-%m-%d'), try_strptime({text}, '%m/%d/%Y')) AS DATE)"


SQL["sanitize_schedule"] = f"""WITH {ORACLE_CTES},
raw AS (
  SELECT id, company_code, borrower_contract_id,
         {_raw_date('installment_date')} AS date,
         CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 100000 AS VARCHAR) END AS ref,
         CASE WHEN id % 101 = 0 THEN NULL ELSE gross_amount END AS gross_amount,
         CASE WHEN id % 23 = 0 THEN 0 ELSE principal_amount END AS principal_amount, interest_amount, tax_amount,
         CASE WHEN id % 7 = 0 THEN NULL ELSE fee_amount END AS fee_amount
  FROM schedule
),
t AS (
  SELECT id, company_code, borrower_contract_id, ref AS borrower_installment_reference,
         {_read_date('date')} AS installment_date,
         CAST(gross_amount AS {M}) AS gross_amount,
         CAST(0 AS {M}) AS guarantee_amount,
         CAST(COALESCE(principal_amount, 0) AS {M}) AS principal_amount,
         CAST(COALESCE(interest_amount, 0) AS {M}) AS interest_amount,
         CAST(COALESCE(tax_amount, 0) AS {M}) AS tax_amount,
         CAST(COALESCE(fee_amount, 0) AS {M}) AS fee_amount
  FROM raw
)
SELECT id, company_code, borrower_contract_id, borrower_installment_reference, installment_date, gross_amount,
       guarantee_amount,
       CAST(CASE WHEN guarantee_amount + principal_amount + interest_amount + tax_amount + fee_amount = 0
                      AND COALESCE(gross_amount, 0) > 0 THEN gross_amount ELSE principal_amount END AS {M})
         AS principal_amount,
       interest_amount, tax_amount, fee_amount
FROM t"""

SQL["schedule_position_ids"] = f"""
SELECT COALESCE(CASE WHEN l_partkey % 3 <> 0 THEN l_orderkey * 10 + l_linenumber END, ROW_NUMBER() OVER ()) AS id,
       CAST(l_orderkey AS VARCHAR) AS borrower_contract_id, CAST(l_shipdate AS DATE) AS installment_date,
       CAST(l_extendedprice AS {M}) AS gross_amount
FROM lineitem"""

SQL["sanitize_payments"] = f"""WITH {ORACLE_CTES},
raw AS (SELECT *, {_raw_date('payment_date')} AS date FROM payments)
SELECT id, company_id, borrower_contract_id, {_read_date('date')} AS payment_date,
       CASE WHEN id % 19 = 0 THEN NULL ELSE total_payment END AS total_payment, borrower_installment_reference
FROM raw"""

_FALLBACK = ("(guarantee_amount + principal_amount + interest_amount + tax_amount + fee_amount = 0 "
             "AND COALESCE(gross_amount, 0) > 0)")
SQL["bucket_fallback"] = f"""WITH {ORACLE_CTES}
SELECT company_code,
       COUNT(*) FILTER (WHERE {_FALLBACK}) AS filled_rows,
       CAST(SUM(CASE WHEN {_FALLBACK} THEN gross_amount END) AS {M}) AS filled_gross
FROM schedule GROUP BY company_code"""

SQL["rescue_reference"] = f"""WITH {ORACLE_CTES}
SELECT id, borrower_contract_id, payment_date, total_payment, borrower_installment_reference FROM payments"""

SQL["freshness_dates"] = f"""WITH {ORACLE_CTES},
cm AS (SELECT * FROM (VALUES (1, 'AUTOMOBILE'), (2, 'BUILDING'), (3, 'FURNITURE'), (4, 'HOUSEHOLD'), (5, 'MACHINERY'))
       AS t(company_id, company_code)),
sd AS (SELECT company_code, MAX(installment_date) AS last_schedule_payment_date FROM schedule GROUP BY 1),
pd AS (SELECT company_id, MAX(payment_date) AS last_payment_tape_date,
              MAX(CASE WHEN total_payment > 0 THEN payment_date END) AS last_payment_date
       FROM payments GROUP BY 1)
SELECT cm.company_id, cm.company_code, sd.last_schedule_payment_date, pd.last_payment_tape_date, pd.last_payment_date
FROM cm LEFT JOIN sd ON cm.company_code = sd.company_code LEFT JOIN pd ON cm.company_id = pd.company_id"""

PREV = "DATE '1997-12-31'"

SQL["current_dpd_by_contract"] = BASE + cascade_ctes() + """
SELECT *, ROW_NUMBER() OVER (ORDER BY dpd_credito DESC, borrower_contract_id) AS position
FROM (SELECT borrower_contract_id, MAX(dpd_current) AS dpd_credito FROM c GROUP BY 1)"""

SQL["max_dpd_by_contract"] = BASE + cascade_ctes() + cascade_ctes(calc=PREV, name="c0") + """
SELECT *, ROW_NUMBER() OVER (ORDER BY max_tiempo_mora DESC, borrower_contract_id) AS position
FROM (SELECT c.borrower_contract_id, MAX(GREATEST(c.dpd_current, COALESCE(c0.dpd_current, 0))) AS max_tiempo_mora
      FROM c LEFT JOIN c0 ON c.id = c0.id AND c.borrower_contract_id = c0.borrower_contract_id
                         AND c.installment_date = c0.installment_date
      GROUP BY 1)"""

SQL["run_counters"] = DETAIL + """
SELECT COUNT(*) AS instalments, COUNT(DISTINCT borrower_contract_id) AS contracts,
       COUNT(*) FILTER (WHERE cascade_dpd > 0) AS cascade_late,
       COUNT(*) FILTER (WHERE join_dpd > 0) AS join_late
FROM d"""

_F_CUR = """,
f AS (
  SELECT borrower_contract_id, MAX(dpd_current) AS d, SUM(CASE WHEN dpd_current > 0 THEN amount_in_arrears END) AS arr
  FROM c GROUP BY 1
),
f0 AS (SELECT borrower_contract_id, MAX(dpd_current) AS d FROM c0 GROUP BY 1),
prev AS (SELECT lt.borrower_contract_id, MAX(CAST(COALESCE(f0.d, 0) AS INTEGER)) AS prev_max
         FROM loan_tape lt LEFT JOIN f0 ON lt.borrower_contract_id = f0.borrower_contract_id GROUP BY 1)"""

SQL["dpd_max_history"] = BASE + cascade_ctes() + cascade_ctes(calc=PREV, name="c0") + _F_CUR + f"""
SELECT {LOAN_COLS},
       CAST(COALESCE(f.d, 0) AS INTEGER) AS dpd_current,
       CAST(GREATEST(COALESCE(f.d, 0), COALESCE(prev.prev_max, 0)) AS INTEGER) AS dpd_max,
       CAST(COALESCE(f.arr, 0) AS {M}) AS amount_in_arrears
FROM loan_tape lt
LEFT JOIN f ON lt.borrower_contract_id = f.borrower_contract_id
LEFT JOIN prev ON lt.borrower_contract_id = prev.borrower_contract_id"""

_PV = (f"CAST(COALESCE(gross_amount, 0) AS DOUBLE) * (1.0 / pow(CAST({1.0 + INVESTOR_RATE!r} AS DOUBLE), "
       f"CAST(date_diff('day', {CALC}, installment_date) AS DOUBLE) / 365.25))")

SQL["enrich_loan_tape"] = BASE + cascade_ctes() + cascade_ctes(calc=PREV, name="c0") + _F_CUR + f""",
tp AS (SELECT borrower_contract_id, SUM(total_payment) AS paid FROM payments WHERE total_payment > 0 GROUP BY 1),
npv AS (SELECT borrower_contract_id, SUM({_PV}) AS pv FROM s WHERE installment_date > {CALC} GROUP BY 1)
SELECT {LOAN_COLS},
       CAST(COALESCE(f.d, 0) AS INTEGER) AS dpd_current,
       CAST(GREATEST(COALESCE(f.d, 0), COALESCE(prev.prev_max, 0)) AS INTEGER) AS dpd_max,
       CAST(COALESCE(f.arr, 0) AS {M}) AS amount_in_arrears,
       CAST(COALESCE(tp.paid, 0) AS {M}) AS total_amount_paid,
       round(COALESCE(npv.pv, 0.0), 2) AS vpn,
       '1998-07-01T06:00:00+00:00' AS last_update_date,
       'job-0001' AS payment_tape_ref
FROM loan_tape lt
LEFT JOIN f ON lt.borrower_contract_id = f.borrower_contract_id
LEFT JOIN prev ON lt.borrower_contract_id = prev.borrower_contract_id
LEFT JOIN tp ON lt.borrower_contract_id = tp.borrower_contract_id
LEFT JOIN npv ON lt.borrower_contract_id = npv.borrower_contract_id"""

SQL["companies_without_schedule"] = f"""WITH {ORACLE_CTES}
SELECT lt.* EXCLUDE (company_code), 'B' || lt.borrower_contract_id AS company_code FROM loan_tape lt
WHERE lt.borrower_contract_id NOT IN (SELECT borrower_contract_id FROM schedule)"""


def _shared(sql: str) -> str:
    """The statement over contract ids that are only unique within a company."""
    return sql.replace(ORACLE_CTES, SHARED_ORACLE_CTES)


_SPLIT = "split_part({0}borrower_contract_id, ':', 1) AS company_code, split_part({0}borrower_contract_id, ':', 2) AS borrower_contract_id"

SQL["portfolio_enrichment"] = f"""SELECT * EXCLUDE (borrower_contract_id, company_code, last_update_date, payment_tape_ref), {_SPLIT.format('')}
FROM ({_shared(SQL['enrich_loan_tape'])})"""

# --- schedule generation -------------------------------------------------------

TERMS = f"""WITH RECURSIVE {ORACLE_CTES},
t1 AS (
  SELECT borrower_contract_id, company_code, original_principal AS principal, num_installments AS n,
         interest_rate AS annual_rate, first_installment_date,
         COALESCE(CASE lower(trim(periodicity))
                    WHEN 'monthly' THEN 'monthly' WHEN 'biweekly' THEN 'biweekly' WHEN 'weekly' THEN 'weekly'
                    WHEN 'daily' THEN 'daily' WHEN 'mensual' THEN 'monthly' WHEN 'quincenal' THEN 'biweekly'
                    WHEN 'semanal' THEN 'weekly' WHEN 'diario' THEN 'daily' WHEN 'm' THEN 'monthly'
                    WHEN 'b' THEN 'biweekly' WHEN 'w' THEN 'weekly' WHEN 'd' THEN 'daily' END, 'monthly') AS periodicity
  FROM loan_tape
),
t2 AS (
  SELECT *, pow(1.0 + annual_rate, 1.0 / CASE periodicity WHEN 'monthly' THEN 12 WHEN 'biweekly' THEN 26
                                                          WHEN 'weekly' THEN 52 ELSE 365 END) - 1.0 AS r
  FROM t1
),
terms AS (
  SELECT *, CAST(r AS DECIMAL(19,18)) AS rdec,
         CASE WHEN r = 0
              THEN CAST(CAST((2 * CAST(principal * 1000000 AS HUGEINT) + 10000 * n) // (20000 * n) AS DECIMAL(18,0))
                        * 0.01 AS DECIMAL(18,2))
              ELSE CAST(round(CAST(CAST(CAST(principal AS DOUBLE) * r / (1.0 - pow(1.0 + r, -CAST(n AS DOUBLE)))
                                        AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(18,2)) END AS payment
  FROM t2
  WHERE principal IS NOT NULL AND n IS NOT NULL AND n <> 0 AND annual_rate IS NOT NULL
    AND first_installment_date IS NOT NULL
)"""

# The same with the faults of the messy tape: what cannot be built is left out.
_K = "CAST(borrower_contract_id AS BIGINT)"
MESSY = f"""messy AS (
  SELECT borrower_contract_id, company_code, first_date AS first_installment_date, principal, rate AS interest_rate, n,
         CASE WHEN {_K} % 499 = 7 THEN 'diario' ELSE periodicity END AS periodicity,
         list_filter([CASE WHEN principal IS NULL THEN 'original_principal is not a number' END,
                      CASE WHEN n = 0 THEN 'num_installments is zero' END,
                      CASE WHEN n < 0 THEN 'num_installments is negative' END,
                      CASE WHEN rate IS NULL THEN 'interest_rate is not a number' END,
                      CASE WHEN first_date IS NULL THEN 'first_installment_date is not a date' END,
                      CASE WHEN rate <= -1 THEN 'interest_rate is -100% or less' END], lambda x: x IS NOT NULL) AS errs
  FROM (SELECT *,
               CASE WHEN {_K} % 97 = 0 THEN NULL WHEN {_K} % 89 = 0 THEN 2500000000000 ELSE original_principal END AS principal,
               CASE WHEN {_K} % 499 = 7 THEN 3650 WHEN {_K} % 41 = 0 THEN -3 ELSE CAST({_K} % 36 AS INTEGER) END AS n,
               CASE WHEN {_K} % 83 = 0 THEN -1.5 WHEN {_K} % 79 = 0 THEN NULL ELSE interest_rate END AS rate,
               CASE WHEN {_K} % 73 = 0 THEN NULL ELSE first_installment_date END AS first_date
        FROM loan_tape)
)"""
_RENAMED = "original_principal AS principal, num_installments AS n,"
assert _RENAMED in TERMS and "  FROM loan_tape\n)," in TERMS
MESSY_TERMS = TERMS.replace(f"{ORACLE_CTES},", f"{ORACLE_CTES},\n{MESSY},", 1).replace(_RENAMED, "CAST(principal AS DECIMAL(26,6)) AS principal, n,").replace(
    "  FROM loan_tape\n),", "  FROM messy WHERE len(errs) = 0\n),")

SQL["period_rate"] = TERMS.replace("WITH RECURSIVE", "WITH") + """
SELECT borrower_contract_id, periodicity, CAST(r AS DECIMAL(19,18)) AS period_rate FROM t2"""

SQL["level_payment"] = TERMS.replace("WITH RECURSIVE", "WITH") + """
SELECT borrower_contract_id, payment FROM terms"""

_DUE = """CAST(CASE periodicity
           WHEN 'biweekly' THEN first_installment_date + CAST(14 * (i - 1) AS INTEGER)
           WHEN 'weekly' THEN first_installment_date + CAST(7 * (i - 1) AS INTEGER)
           WHEN 'daily' THEN first_installment_date + CAST(i - 1 AS INTEGER)
           ELSE CAST(first_installment_date + to_months(CAST(i - 1 AS INTEGER)) AS DATE) END AS DATE)"""

SQL["due_dates"] = TERMS.replace("WITH RECURSIVE", "WITH") + f""",
steps AS (SELECT borrower_contract_id, first_installment_date, periodicity, CAST(unnest(range(1, n + 1)) AS INTEGER) AS i
          FROM terms WHERE n >= 1)
SELECT borrower_contract_id, i AS installment_number, {_DUE} AS installment_date FROM steps"""

SQL["generate_schedule"] = MESSY_TERMS + f""",
amort AS (
  SELECT borrower_contract_id, company_code, first_installment_date, periodicity, n, rdec, payment,
         0 AS i, CAST(principal AS DECIMAL(26,6)) AS bal,
         CAST(NULL AS DECIMAL(18,2)) AS interest, CAST(NULL AS DECIMAL(26,6)) AS princ
  FROM terms WHERE n >= 1
  UNION ALL
  SELECT borrower_contract_id, company_code, first_installment_date, periodicity, n, rdec, payment,
         i + 1,
         CAST(GREATEST(bal - CAST(CASE WHEN i + 1 < n
                                       THEN GREATEST(payment - CAST(round(bal * rdec, 2) AS DECIMAL(18,2)), 0.01)
                                       ELSE bal END AS DECIMAL(26,6)), 0) AS DECIMAL(26,6)),
         CAST(round(bal * rdec, 2) AS DECIMAL(18,2)),
         CAST(CASE WHEN i + 1 < n THEN GREATEST(payment - CAST(round(bal * rdec, 2) AS DECIMAL(18,2)), 0.01)
                   ELSE bal END AS DECIMAL(26,6))
  FROM amort WHERE i < n
)
SELECT company_code, borrower_contract_id,
       CAST(i AS VARCHAR) AS borrower_installment_reference,
       CAST(i AS INTEGER) AS installment_number,
       {_DUE} AS installment_date,
       CAST(round(princ + interest, 2) AS {M}) AS gross_amount,
       CAST(0 AS {M}) AS guarantee_amount,
       CAST(princ AS {M}) AS principal_amount,
       CAST(interest AS {M}) AS interest_amount,
       CAST(0 AS {M}) AS tax_amount,
       CAST(0 AS {M}) AS fee_amount
FROM amort WHERE i >= 1"""

SQL["schedule_append_idempotent"] = f"""SELECT * REPLACE ('ONE' AS company_code) FROM ({SQL['generate_schedule']})"""

SQL["schedule_append_concurrent"] = SQL["schedule_append_idempotent"]

SQL["schedule_rejects"] = f"""WITH {ORACLE_CTES},
{MESSY}
SELECT borrower_contract_id, array_to_string(errs, '; ') AS errors FROM messy WHERE len(errs) > 0"""

# --- classifier: positional statement of the rules (windows, LEAD, arg_min) ----

CLASSIFY = BASE + f""",
p AS (SELECT * FROM payments WHERE borrower_contract_id IS NOT NULL),
pr AS (
  SELECT borrower_contract_id, borrower_installment_reference,
         SUM(total_payment) AS tp, COUNT(total_payment) AS np
  FROM p WHERE borrower_installment_reference IS NOT NULL GROUP BY 1, 2
),
o AS (
  SELECT s.borrower_contract_id, s.borrower_installment_reference, s.installment_date, s.id, s.gross_amount AS g,
         COALESCE(pr.tp, 0) AS tp, COALESCE(pr.np, 0) AS np,
         ROW_NUMBER() OVER (PARTITION BY s.borrower_contract_id ORDER BY s.installment_date, s.id) - 1 AS pos,
         COUNT(*) OVER (PARTITION BY s.borrower_contract_id) AS n
  FROM s LEFT JOIN pr ON s.borrower_contract_id = pr.borrower_contract_id
                     AND s.borrower_installment_reference = pr.borrower_installment_reference
  WHERE s.installment_date <= {CALC} AND s.borrower_contract_id IS NOT NULL
),
of AS (
  SELECT *,
         COALESCE(ABS(tp - g) < 0.001, false) AS ex,
         COALESCE(tp > 0 AND tp + 0.001 < g, false) AS pa,
         COALESCE(tp = 0, false) AS un,
         COALESCE(tp > g + 0.001, false) AS ov,
         COALESCE(tp >= g - 0.001, false) AS co,
         COALESCE((g - tp) > 0.001 AND (g - tp) < 1.0, false) AS ce,
         CASE WHEN g = 0 THEN CASE WHEN tp > 0 THEN CAST('inf' AS DOUBLE) WHEN tp < 0 THEN CAST('-inf' AS DOUBLE) END
              ELSE CAST(tp AS DOUBLE) / CAST(g AS DOUBLE) END AS ratio,
         CAST(tp AS DOUBLE) / CAST(CASE WHEN g = 0 THEN 1 ELSE g END AS DOUBLE) AS ratio15,
         LEAD(tp) OVER (PARTITION BY borrower_contract_id ORDER BY pos) AS next_tp,
         LEAD(g) OVER (PARTITION BY borrower_contract_id ORDER BY pos) AS next_g
  FROM o
),
agg AS (
  SELECT borrower_contract_id, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE ex) AS ne, COUNT(*) FILTER (WHERE pa) AS npa, COUNT(*) FILTER (WHERE un) AS nu,
         COUNT(*) FILTER (WHERE ov) AS no, COUNT(*) FILTER (WHERE co) AS nc,
         MAX(np) AS max_np, BOOL_OR(ce) AS cents, MAX(ratio) AS ratio_max, BOOL_OR(ratio15 >= 1.9) AS dup15,
         BOOL_OR(pos = n - 1 AND pa) AS last_pa,
         COUNT(*) FILTER (WHERE ex AND pos < n - 1) AS ne_head,
         COUNT(*) FILTER (WHERE ex AND pos > 0) AS ne_tail,
         BOOL_OR(pos = 0 AND ex) AS first_ex, BOOL_OR(pos = 0 AND un) AS first_un,
         COALESCE(BOOL_OR(g > 0 AND ratio >= 1.4 AND ratio <= 1.6 AND next_g IS NOT NULL AND next_tp + 0.001 < next_g),
                  false) AS r9,
         string_agg(CASE WHEN ex THEN 'e' WHEN un THEN 'u' ELSE '-' END, '' ORDER BY pos) AS pattern
  FROM of GROUP BY 1
),
le AS (
  SELECT p.borrower_contract_id,
         COALESCE(BOOL_OR(p.payment_date > s.installment_date), false) AS late,
         COALESCE(BOOL_OR(p.payment_date < s.installment_date), false) AS early
  FROM p JOIN s ON p.borrower_contract_id = s.borrower_contract_id
               AND p.borrower_installment_reference = s.borrower_installment_reference
  GROUP BY 1
),
ofirst AS (SELECT borrower_contract_id, borrower_installment_reference, arg_min(g, pos) AS g_first FROM of GROUP BY 1, 2),
tw AS (  -- two dated payments of one month, the only ones on their reference, that add up to its first overdue gross
  SELECT ofirst.borrower_contract_id, BOOL_OR(ABS(a.total_payment + b.total_payment - ofirst.g_first) < 0.01) AS twice
  FROM ofirst
  JOIN p a ON ofirst.borrower_contract_id = a.borrower_contract_id
          AND ofirst.borrower_installment_reference = a.borrower_installment_reference
  JOIN p b ON a.borrower_contract_id = b.borrower_contract_id
          AND a.borrower_installment_reference = b.borrower_installment_reference
          AND a.id < b.id AND date_trunc('month', a.payment_date) = date_trunc('month', b.payment_date)
  WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.borrower_contract_id = a.borrower_contract_id
                    AND c.borrower_installment_reference = a.borrower_installment_reference AND c.id NOT IN (a.id, b.id))
  GROUP BY 1
),
pc AS (SELECT borrower_contract_id, COUNT(*) AS n_pay, COALESCE(BOOL_OR(payment_date = {CALC}), false) AS on_cut
       FROM p GROUP BY 1),
k AS (SELECT DISTINCT borrower_contract_id FROM s WHERE borrower_contract_id IS NOT NULL),
x AS (
  SELECT k.borrower_contract_id, COALESCE(agg.n, 0) AS n, agg.ne, agg.npa, agg.nu, agg.no, agg.nc, agg.max_np,
         agg.cents, agg.ratio_max, agg.dup15, agg.last_pa, agg.ne_head, agg.ne_tail, agg.first_ex, agg.first_un,
         agg.r9, agg.pattern,
         COALESCE(le.late, false) AS late, COALESCE(le.early, false) AS early,
         COALESCE(tw.twice, false) AS twice, COALESCE(pc.n_pay, 0) AS n_pay, COALESCE(pc.on_cut, false) AS on_cut
  FROM k LEFT JOIN agg USING (borrower_contract_id) LEFT JOIN le USING (borrower_contract_id)
         LEFT JOIN tw USING (borrower_contract_id) LEFT JOIN pc USING (borrower_contract_id)
),
r AS (
  SELECT borrower_contract_id, n, n_pay,
         list_filter([
           CASE WHEN ne = n AND NOT late AND NOT early AND no = 0 THEN 1 END,
           CASE WHEN n >= 2 AND npa = 1 AND nu = 0 AND no = 0 AND last_pa AND ne_head = n - 1 THEN 2 END,
           CASE WHEN nc = n AND late AND NOT early AND max_np <= 1 AND NOT twice AND NOT on_cut THEN 4 END,
           CASE WHEN n >= 3 AND npa = 1 AND nu = 0 AND no = 0 AND NOT last_pa AND ne + npa = n AND NOT cents THEN 5 END,
           CASE WHEN ne = n AND early AND NOT late AND no = 0 THEN 6 END,
           CASE WHEN no = 1 AND npa = 0 AND nu = 0 AND ratio_max >= 1.001 AND ratio_max <= 1.4
                     AND NOT late AND NOT early AND NOT on_cut THEN 7 END,
           CASE WHEN npa >= 2 THEN 8 END,
           CASE WHEN r9 THEN 9 END,
           CASE WHEN twice THEN 10 END,
           CASE WHEN ne = 1 AND nu >= 2 AND npa = 0 AND first_ex THEN 11 END,
           CASE WHEN on_cut THEN 12 END,
           CASE WHEN cents THEN 13 END,
           CASE WHEN dup15 THEN 15 END,
           CASE WHEN n >= 2 AND first_un AND ne_tail = n - 1 AND npa = 0 AND no = 0 THEN 16 END,
           CASE WHEN NOT late AND regexp_full_match(pattern, 'ee+u+') THEN 18 END  -- paid exactly, then not at all
         ], lambda v: v IS NOT NULL) AS matched
  FROM x
),
lab AS (
  SELECT borrower_contract_id,
         CASE WHEN n = 0 THEN 'Sin clasificar'
              WHEN n_pay = 0 THEN '3, 17'
              WHEN len(matched) = 0 THEN 'Sin clasificar'
              ELSE array_to_string(matched, ', ') END AS case_label
  FROM r
)"""

SQL["classify_contracts"] = CLASSIFY + """
SELECT borrower_contract_id, case_label FROM lab"""

SQL["case_histogram"] = CLASSIFY + """
SELECT trim(c) AS case_label, COUNT(*) AS contracts
FROM (SELECT unnest(string_split(case_label, ',')) AS c FROM lab)
GROUP BY 1"""

# --- requests ------------------------------------------------------------------

_REQ = """WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, substr(o_orderpriority, 1, 1) AS digit,
         o_orderkey % 101 = 0 AS malformed,
         (['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(o_orderkey % 5 + 1 AS INTEGER)] AS company
  FROM orders
),
v AS (
  SELECT CASE WHEN malformed THEN NULL ELSE 'job-' || CAST(o_orderkey AS VARCHAR) END AS job_id,
         malformed,
         CASE WHEN malformed THEN 'malformed JSON'
              ELSE concat_ws('; ', CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'unknown products: npv' END,
                                   CASE WHEN digit = '5' THEN 'invalid rate_type: floating' END) END AS errors,
         CASE WHEN NOT malformed AND o_orderstatus = 'O' AND o_custkey % 4 = 0
              THEN 'vpn without interest_rate: no discount' ELSE '' END AS warnings
  FROM o
)"""

SQL["parse_requests"] = _REQ + """
SELECT CASE WHEN malformed THEN NULL ELSE 'job-' || CAST(o_orderkey AS VARCHAR) END AS job_id,
       malformed,
       CASE WHEN malformed THEN NULL ELSE 'PORTFOLIO_DESK' END AS origin,
       CASE WHEN malformed THEN NULL ELSE 'ARREARS_SERVICE' END AS target,
       CASE WHEN malformed THEN NULL ELSE '/data/loans/' || company || '.parquet' END AS input_file,
       CASE WHEN malformed THEN NULL ELSE '/data/out/' || company || '.parquet' END AS output_file,
       CASE WHEN malformed THEN NULL ELSE 'borrower_contract_id' END AS key,
       CASE WHEN malformed THEN NULL ELSE 'COMPANY' END AS target_type,
       CASE WHEN malformed THEN NULL ELSE CAST(o_orderkey % 5 + 1 AS INTEGER) END AS target_id,
       CASE WHEN malformed THEN 'fixed' WHEN digit = '5' THEN 'floating' WHEN digit = '3' THEN 'variable'
            ELSE 'fixed' END AS rate_type,
       CASE WHEN malformed THEN '' WHEN o_orderstatus = 'F' THEN 'dpd,total_amount'
            WHEN o_orderstatus = 'O' THEN 'dpd,vpn' ELSE 'dpd,npv' END AS products,
       CASE WHEN malformed OR o_custkey % 4 = 0 THEN NULL
            ELSE CAST(CAST(0.01 AS DECIMAL(3,2)) * (o_custkey % 20) AS DOUBLE) END AS interest_rate,
       CASE WHEN NOT malformed AND o_orderkey % 7 = 0 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END
         AS paid_threshold
FROM o"""

SQL["validate_requests"] = _REQ + """
SELECT job_id, malformed, errors, warnings FROM v"""

SQL["rejected_requests"] = _REQ + """
SELECT job_id, errors FROM v WHERE errors <> ''"""

_BODY = """'{"origin":"PORTFOLIO_DESK","target":"ARREARS_SERVICE","job_id":"job-' || o_orderkey
  || '","input_file":"/data/loans/' || company || '.parquet","output_file":"/data/out/' || company
  || '.parquet","key":"borrower_contract_id","target_type":"COMPANY","target_id":'
  || CASE WHEN o_custkey % 3 = 0 THEN '"' || (o_orderkey % 5 + 1) || '"' ELSE CAST(o_orderkey % 5 + 1 AS VARCHAR) END
  || CASE digit WHEN '5' THEN ',"rate_type":"floating"' WHEN '4' THEN '' WHEN '3' THEN ',"rate_type":"variable"'
                ELSE ',"rate_type":"fixed"' END
  || ',"metadata":{"products":["dpd","' || CASE o_orderstatus WHEN 'F' THEN 'total_amount' WHEN 'O' THEN 'vpn' ELSE 'npv' END || '"]'
  || CASE WHEN o_custkey % 4 = 0 THEN ''
          ELSE ',"interest_rate":' || CAST(CAST(CAST(0.01 AS DECIMAL(3,2)) * (o_custkey % 20) AS DOUBLE) AS VARCHAR) END
  || CASE WHEN o_orderkey % 7 = 0 THEN ',"paid_threshold":0.8' ELSE '' END || '}}'"""

SQL["dedup_requests"] = _REQ + f""",
b AS (SELECT malformed, {_BODY} AS body FROM o),
c AS (SELECT DISTINCT CASE WHEN malformed THEN substr(body, 1, length(body) - 7) ELSE body END AS body FROM b)
SELECT sha256(body) AS body_hash, body FROM c"""

_FRESH = SQL["freshness_dates"]

SQL["build_responses"] = _REQ + f""",
f AS ({_FRESH})
SELECT 'ARREARS_SERVICE' AS origin, 'PORTFOLIO_DESK' AS target, 'job-' || o_orderkey AS job_id,
       '/data/loans/' || company || '.parquet' AS input_file, '/data/out/' || company || '.parquet' AS output_file,
       'borrower_contract_id' AS key, 'COMPANY' AS target_type, CAST(o_orderkey % 5 + 1 AS INTEGER) AS target_id,
       CASE o_orderstatus WHEN 'F' THEN 'dpd,total_amount' ELSE 'dpd,vpn' END AS products,
       CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(CAST(0.01 AS DECIMAL(3,2)) * (o_custkey % 20) AS DOUBLE) END AS interest_rate,
       f.last_payment_tape_date, f.last_schedule_payment_date, f.last_payment_date, 'PORTFOLIO_DESK' AS routed_to
FROM o JOIN f ON f.company_id = o_orderkey % 5 + 1
WHERE NOT malformed AND o_orderstatus IN ('F', 'O') AND digit <> '5'"""

SQL["response_records"] = _REQ + """
SELECT 'job-' || o_orderkey AS key, CAST(o_orderkey % 5 + 1 AS INTEGER) AS target_id, 'ARREARS_SERVICE' AS origin,
       'PORTFOLIO_DESK' AS target, 3 AS n_headers
FROM o WHERE NOT malformed AND o_orderstatus IN ('F', 'O') AND digit <> '5'"""

SQL["repeated_requests"] = _REQ + f""",
b AS (SELECT malformed, {_BODY} AS body FROM o),
c AS (SELECT CASE WHEN malformed THEN substr(body, 1, length(body) - 7) ELSE body END AS body FROM b)
SELECT sha256(body) AS body_hash, CAST(1 AS BIGINT) AS served,
       CAST(COUNT(*) + COUNT(*) FILTER (WHERE length(body) % 3 = 0) - 1 AS BIGINT) AS left_out
FROM c GROUP BY body"""

# The last valid request of each company decides the paid share; dpd_max sees the highest share of all.
SQL["requests_stream"] = BASE + cascade_ctes(name="c") + f""",
o AS ({_REQ[len('WITH o AS ('):_REQ.index('),')]}),
valid AS (SELECT company, 'job-' || o_orderkey AS job_id, CASE WHEN o_orderkey % 7 = 0 THEN 0.8 ELSE 1.0 END AS share
          FROM o WHERE NOT malformed AND o_orderstatus IN ('F', 'O') AND digit <> '5'),
last AS (SELECT company, max(job_id) AS job_id, arg_max(share, job_id) AS share, max(share) AS highest FROM valid GROUP BY 1),
late AS (
  SELECT c.borrower_contract_id,
         MAX(CASE WHEN applied_amount >= gross_amount * last.share THEN 0 ELSE {_dpd(1)} END) AS d,
         MAX(CASE WHEN applied_amount >= gross_amount * last.highest THEN 0 ELSE {_dpd(1)} END) AS dm,
         SUM(CASE WHEN applied_amount < gross_amount * last.share AND {_dpd(1)} > 0
                  THEN GREATEST(gross_amount - applied_amount, 0) END) AS arr
  FROM c JOIN last ON last.company = c.company_code GROUP BY 1
)
SELECT lt.borrower_contract_id, lt.company_code, CAST(COALESCE(late.d, 0) AS INTEGER) AS dpd_current,
       CAST(COALESCE(GREATEST(late.d, late.dm), 0) AS INTEGER) AS dpd_max,
       CAST(COALESCE(late.arr, 0) AS {M}) AS amount_in_arrears, last.job_id AS payment_tape_ref
FROM loan_tape lt JOIN last ON last.company = lt.company_code LEFT JOIN late USING (borrower_contract_id)"""

SQL["load_loan_tape"] = f"""WITH {ORACLE_CTES}
SELECT CAST(borrower_contract_id AS INTEGER) AS borrower_contract_id, company_code, company_id,
       CAST(original_principal AS DOUBLE) AS original_principal, num_installments, interest_rate, first_installment_date,
       trim(periodicity) AS periodicity
FROM loan_tape"""

_DETAIL_TAIL = DETAIL[len(BASE):]
_CLASSIFY_TAIL = CLASSIFY[len(BASE):]

SQL["summary_with_cases"] = BASE + _DETAIL_TAIL + _CLASSIFY_TAIL + f""",
summ AS (
  SELECT borrower_contract_id,
         COUNT(id) AS cuotas,
         MAX(cascade_dpd) AS cascade_dpd_max,
         CAST(COALESCE(SUM(CASE WHEN cascade_dpd > 0 THEN cascade_arrears END), 0) AS {M}) AS cascade_arrears_total,
         MAX(join_dpd) AS join_dpd_max,
         CAST(COALESCE(SUM(CASE WHEN join_dpd > 0 THEN join_arrears END), 0) AS {M}) AS join_arrears_total
  FROM d WHERE borrower_contract_id IS NOT NULL
  GROUP BY borrower_contract_id
)
SELECT summ.*, lab.case_label AS "case"
FROM summ LEFT JOIN lab ON summ.borrower_contract_id = lab.borrower_contract_id"""

SQL["detail_with_cases"] = BASE + _DETAIL_TAIL + _CLASSIFY_TAIL + """
SELECT d.*, MAX(cascade_dpd) OVER (PARTITION BY d.borrower_contract_id) AS max_cascade_dpd,
       MAX(join_dpd) OVER (PARTITION BY d.borrower_contract_id) AS max_join_dpd, lab.case_label AS "case"
FROM d LEFT JOIN lab ON d.borrower_contract_id = lab.borrower_contract_id"""

SQL["portfolio_summary_with_cases"] = f"""SELECT * EXCLUDE (borrower_contract_id), {_SPLIT.format('')}
FROM ({_shared(SQL['summary_with_cases'])})"""

SQL["export_detail_summary"] = f"""
SELECT 'detail' AS part, borrower_contract_id, id, CAST(NULL AS BIGINT) AS cuotas, cascade_dpd, cascade_arrears, join_dpd, join_arrears
FROM ({SQL['detail_both']})
UNION ALL
SELECT 'summary', borrower_contract_id, NULL, cuotas, cascade_dpd_max, cascade_arrears_total, join_dpd_max, join_arrears_total
FROM ({SQL['summary_both']})"""

SQL["generation_gate"] = f"""WITH {ORACLE_CTES},
sc AS (SELECT DISTINCT borrower_contract_id FROM schedule)
SELECT 'B' || lt.borrower_contract_id AS company_code,
       CASE WHEN num_installments % 2 = 0 THEN 'variable' ELSE 'fixed' END AS rate_type,
       CASE WHEN sc.borrower_contract_id IS NOT NULL THEN 'use_schedule'
            WHEN num_installments % 2 = 0 THEN 'reject' ELSE 'generate' END AS decision
FROM loan_tape lt LEFT JOIN sc USING (borrower_contract_id)"""

SQL["bucket_mismatch"] = BASE + """
SELECT company_code, COUNT(*) AS instalments,
       COUNT(*) FILTER (WHERE COALESCE(guarantee_amount + principal_amount + interest_amount + tax_amount + fee_amount
                                       <> gross_amount, false)) AS mismatched
FROM s GROUP BY company_code"""

SQL["batch_enrichment"] = BASE + cascade_ctes() + f""",
u AS (SELECT lt.borrower_contract_id, lt.company_code, CAST(lt.borrower_contract_id AS BIGINT) % 40 AS part FROM loan_tape lt),
late AS (
  SELECT c.company_code, c.borrower_contract_id,
         MAX(CASE WHEN applied_amount >= gross_amount * 0.8 THEN 0 ELSE {_dpd(1)} END) AS d8,
         MAX(CASE WHEN applied_amount >= gross_amount THEN 0 ELSE {_dpd(1)} END) AS d10,
         SUM(CASE WHEN applied_amount < gross_amount * 0.8 AND {_dpd(1)} > 0 THEN GREATEST(gross_amount - applied_amount, 0) END) AS a8,
         SUM(CASE WHEN applied_amount < gross_amount AND {_dpd(1)} > 0 THEN GREATEST(gross_amount - applied_amount, 0) END) AS a10
  FROM c GROUP BY 1, 2
),
tp AS (SELECT borrower_contract_id, SUM(total_payment) AS paid FROM payments WHERE total_payment > 0 GROUP BY 1),
r AS (SELECT *, CASE WHEN part % 5 <> 0 THEN (part % 20) / 100.0 ELSE 0.0 END AS rate FROM u),
npv AS (
  SELECT r.borrower_contract_id, SUM(CASE WHEN rate = 0 THEN CAST(COALESCE(gross_amount, 0) AS DOUBLE)
           ELSE CAST(COALESCE(gross_amount, 0) AS DOUBLE) * (1.0 / pow(1.0 + CAST(rate AS DOUBLE), CAST(date_diff('day', {CALC}, installment_date) AS DOUBLE) / 365.25)) END) AS pv
  FROM s JOIN r ON s.borrower_contract_id = r.borrower_contract_id AND s.company_code = r.company_code WHERE installment_date > {CALC} GROUP BY 1
)
SELECT r.company_code || '/' || part AS unit, r.borrower_contract_id, r.company_code,
       CASE WHEN part % 3 < 2 THEN CAST(COALESCE(CASE WHEN part % 2 = 0 THEN d8 ELSE d10 END, 0) AS INTEGER) END AS dpd_current,
       CASE WHEN part % 3 < 2 THEN CAST(GREATEST(COALESCE(CASE WHEN part % 2 = 0 THEN d8 ELSE d10 END, 0), CASE WHEN part % 4 = 0 THEN COALESCE(d10, 0) ELSE 0 END) AS INTEGER) END AS dpd_max,
       CASE WHEN part % 3 < 2 THEN CAST(COALESCE(CASE WHEN part % 2 = 0 THEN a8 ELSE a10 END, 0) AS {M}) END AS amount_in_arrears,
       CASE WHEN part % 3 > 0 THEN CAST(COALESCE(tp.paid, 0) AS {M}) END AS total_amount_paid,
       CASE WHEN part % 3 > 0 THEN round(COALESCE(npv.pv, 0.0), 2) END AS vpn
FROM r LEFT JOIN late ON late.borrower_contract_id = r.borrower_contract_id AND late.company_code = r.company_code
LEFT JOIN tp ON tp.borrower_contract_id = r.borrower_contract_id
LEFT JOIN npv ON npv.borrower_contract_id = r.borrower_contract_id"""

SQL["dpd_max_state"] = BASE + cascade_ctes() + cascade_ctes(calc=PREV, name="c0") + """,
runs AS (SELECT company_code, borrower_contract_id, dpd_current FROM c UNION ALL SELECT company_code, borrower_contract_id, dpd_current FROM c0)
SELECT company_code, borrower_contract_id, MAX(dpd_current) AS dpd_max FROM runs GROUP BY 1, 2"""
