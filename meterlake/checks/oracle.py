"""SQL statements with the expected result of each registered query.

They are written from the definitions, in the direct form (self-joins, window over all rows, DISTINCT
over the joined rows), not from the plans of the operators.
"""

from __future__ import annotations

VIEWS = {
    "t_readings": """
        SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS meter_id, user_id AS customer_id,
               ts AS reading_datetime, 'GAL' AS unit_of_measure, 'UTC' AS timezone,
               sum(CAST(value AS DECIMAL(18,2))) OVER (
                   PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING
               ) AS reading_value
        FROM events""",
    "t_location": "SELECT CAST(c_custkey AS VARCHAR) AS functionallocation FROM customer",
    "t_register": """
        SELECT c.*, '001' AS register FROM customer c
        UNION ALL SELECT c.*, '002' AS register FROM customer c WHERE c_custkey % 10 = 0""",
    "t_device": """
        SELECT CAST(c_custkey AS VARCHAR) AS devicelocation,
               lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS equipmentnumber,
               c_custkey + 100000 AS installation, register, 'L' || register AS logicalregisternumber,
               DATE '2000-01-01' AS valid_from,
               CASE WHEN c_custkey % 7 = 0 THEN DATE '2010-01-01' ELSE DATE '9999-12-31' END AS valid_to
        FROM t_register""",
    "t_contract": """
        SELECT d.equipmentnumber, d.register, d.valid_from, d.valid_to,
               DATE '2005-01-01' AS move_in,
               CASE WHEN c_custkey % 11 = 0 THEN DATE '2020-01-01' ELSE DATE '9999-12-31' END AS move_out,
               CAST(c_custkey AS VARCHAR) AS businesspartnernumber,
               c_custkey + 500000 AS contractaccount, c_custkey + 700000 AS contract,
               n_name AS district, d.devicelocation
        FROM t_device d JOIN customer ON d.devicelocation = CAST(c_custkey AS VARCHAR)
        JOIN nation ON c_nationkey = n_nationkey""",
    "t_premise": """
        SELECT CAST(c_custkey AS VARCHAR) AS premise, c_custkey + 100000 AS installation,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'SW' ELSE 'W' END AS division
        FROM customer""",
    "t_bills": """
        SELECT CAST(o_custkey AS VARCHAR) AS meter_id, CAST(o_custkey + 100000 AS VARCHAR) AS installation,
               '001' AS register, o_orderdate AS meter_reading_time,
               CASE WHEN o_orderstatus = 'F' THEN '01' ELSE '02' END AS reason,
               CAST(o_totalprice AS DECIMAL(18,2)) AS consumption_gl, c_mktsegment AS unit
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "t_meters": """
        SELECT CAST(c_custkey AS VARCHAR) AS meter_id, CAST(c_custkey + 100000 AS VARCHAR) AS installation,
               register, CAST(c_custkey AS VARCHAR) AS bp, CAST(c_custkey + 500000 AS VARCHAR) AS ccn
        FROM t_register WHERE c_nationkey % 5 <> 0""",
    "t_usage": """
        SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS equipmentnumber,
               CAST(o_custkey AS VARCHAR) AS bp, CAST(o_custkey + 500000 AS VARCHAR) AS ccn,
               l_shipdate AS reading_datetime, CAST(l_extendedprice AS DECIMAL(18,2)) AS consumption
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "t_segment_schedule": """
        SELECT c_mktsegment AS unit, CAST(l_shipdate AS DATE) AS read_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    # Steps that several statements share.
    "hourly_tmp": """
        SELECT *, round(reading_value - lag(reading_value) OVER w, 2) AS consumption,
               CAST(floor(epoch(reading_datetime)) - floor(epoch(lag(reading_datetime) OVER w)) AS INTEGER)
                   AS read_interval
        FROM t_readings
        WHERE reading_datetime BETWEEN TIMESTAMP '2024-01-18' AND TIMESTAMP '2024-01-21'
        WINDOW w AS (PARTITION BY meter_id ORDER BY reading_datetime)""",
    "backfill_tmp": """
        SELECT *, round(reading_value - lag(reading_value) OVER w, 2) AS consumption,
               CAST(floor(epoch(reading_datetime)) - floor(epoch(lag(reading_datetime) OVER w)) AS INTEGER)
                   AS read_interval
        FROM t_readings WHERE reading_datetime > TIMESTAMP '2024-01-10'
        WINDOW w AS (PARTITION BY meter_id ORDER BY reading_datetime)""",
    "doubled_tmp": """
        SELECT meter_id, reading_datetime, reading_value,
               round(reading_value - lag(reading_value) OVER w, 2) AS consumption,
               CAST(floor(epoch(reading_datetime)) - floor(epoch(lag(reading_datetime) OVER w)) AS INTEGER)
                   AS read_interval
        FROM (SELECT * FROM t_readings UNION ALL SELECT * FROM t_readings)
        WINDOW w AS (PARTITION BY meter_id ORDER BY reading_datetime)""",
}

_DELTA = """round(reading_value - lag(reading_value) OVER w, 2)"""
_GAP = """CAST(floor(epoch(reading_datetime)) - floor(epoch(lag(reading_datetime) OVER w)) AS INTEGER)"""
_METER_WINDOW = "WINDOW w AS (PARTITION BY meter_id ORDER BY reading_datetime)"

_READ = """t.meter_id AS headend_meter_id, t.reading_datetime, t.timezone,
    CAST(t.reading_value AS DOUBLE) AS reading_value, t.unit_of_measure,
    CAST(t.consumption AS DOUBLE) AS consumption, t.read_interval,
    i.equipmentnumber, i.installation, i.register, i.logicalregisternumber,
    c.businesspartnernumber, c.contractaccount, c.contract, c.district"""
_DEVICE = "DATE '2024-01-20' BETWEEN i.valid_from AND i.valid_to"
_CONTRACT = """JOIN t_contract c ON c.equipmentnumber = i.equipmentnumber AND c.register = i.register
    AND DATE '2024-01-20' BETWEEN c.valid_from AND c.valid_to
    AND DATE '2024-01-20' BETWEEN c.move_in AND c.move_out"""
_BY_LOCATION = f"""JOIN t_location l ON l.functionallocation = CAST(t.customer_id AS VARCHAR)
    JOIN t_device i ON i.devicelocation = l.functionallocation AND {_DEVICE} {_CONTRACT}"""
_BY_PREMISE = f"""JOIN t_premise p ON p.premise = CAST(t.customer_id AS VARCHAR) AND p.division <> 'SW'
    JOIN t_device i ON i.installation = p.installation AND {_DEVICE} {_CONTRACT}"""
_MASTER = ("t_location", "t_register", "t_device", "t_contract", "t_premise")
_LOCATION = "CAST(t.customer_id AS VARCHAR) AS functionallocation"


def _with(names: tuple[str, ...], body: str, **extra: str) -> str:
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _reads(kind: str, source: str, joins: str, place: str) -> str:
    return f"SELECT DISTINCT '{kind}' AS read_interval_type, {place}, {_READ} FROM {source} t {joins}"


_PREMISE_PLACE = (
    "c.devicelocation AS functionallocation, CAST(t.customer_id AS VARCHAR) AS utilities_premise"
)
_HOURLY = _reads("HOURLY", "hourly_tmp", _BY_LOCATION, _LOCATION)
_HOURLY_ACCOUNT = _reads("HOURLY", "hourly_tmp", _BY_PREMISE, _PREMISE_PLACE).replace(
    "t.timezone", "'GMT' AS timezone"
).replace("t.unit_of_measure", "'' AS unit_of_measure")

_LAST = """
    SELECT r.* FROM t_readings r JOIN (
        SELECT meter_id, max(reading_datetime) AS reading_datetime FROM t_readings
        {where} GROUP BY meter_id, CAST(reading_datetime AS DATE)
    ) USING (meter_id, reading_datetime)"""
_DAILY_LAST = _LAST.format(
    where="WHERE reading_datetime BETWEEN TIMESTAMP '2023-11-19' AND TIMESTAMP '2024-01-20'"
)
_DAY_DELTA = f"SELECT *, {_DELTA} AS consumption, {_GAP} AS read_interval FROM last_row {_METER_WINDOW}"
_DAILY = _reads("DAILY", "daily_tmp", _BY_LOCATION, _LOCATION)
_DAILY_ACCOUNT = _reads("DAILY", "daily_tmp", _BY_PREMISE, _PREMISE_PLACE).replace(
    "t.timezone", "'GMT' AS timezone"
).replace("t.unit_of_measure", "'' AS unit_of_measure")
_DAILY_STEPS = {"last_row": _DAILY_LAST, "daily_tmp": _DAY_DELTA}

_DAILY_PARITY = f"""
    SELECT DISTINCT 'DAILY' AS read_interval_type, {_LOCATION}, t.meter_id AS headend_meter_id,
        t.reading_datetime, t.timezone, CAST(t.reading_value AS DOUBLE) AS reading_value,
        t.unit_of_measure,
        CAST(round(t.reading_value - lag(t.reading_value) OVER w, 2) AS DOUBLE) AS consumption,
        CAST(floor(epoch(t.reading_datetime)) - floor(epoch(lag(t.reading_datetime) OVER w)) AS INTEGER)
            AS read_interval,
        i.equipmentnumber, i.installation, i.register, i.logicalregisternumber,
        c.businesspartnernumber, c.contractaccount, c.contract, c.district
    FROM last_row t {_BY_LOCATION}
    WINDOW w AS (PARTITION BY t.meter_id ORDER BY t.reading_datetime, i.register)"""

_DAILY_ACCOUNT_PARITY = (
    _DAILY_PARITY.replace(_BY_LOCATION, _BY_PREMISE)
    .replace(_LOCATION, _PREMISE_PLACE)
    .replace("t.timezone", "'GMT' AS timezone")
    .replace("t.unit_of_measure", "'' AS unit_of_measure")
)

# Two ports of each meter: their readings and differences are apart.
_PORTS = VIEWS["t_readings"].replace("PARTITION BY user_id", "PARTITION BY user_id, event_id % 2").replace(
    "user_id AS customer_id,", "user_id AS customer_id, event_id % 2 AS port,"
)


def _by_port(sql: str) -> str:
    return (
        sql.replace("PARTITION BY meter_id", "PARTITION BY meter_id, port")
        .replace("SELECT meter_id, max", "SELECT meter_id, port, max")
        .replace("GROUP BY meter_id,", "GROUP BY meter_id, port,")
        .replace("USING (meter_id,", "USING (meter_id, port,")
    )


_PLAIN_READING = "meter_id, reading_datetime, CAST(reading_value AS DOUBLE) AS reading_value"
_PLAIN_DELTA = f"{_PLAIN_READING}, CAST(consumption AS DOUBLE) AS consumption, read_interval"
_INTERVAL_DELTA = f"""
    SELECT {_PLAIN_READING}, CAST({_DELTA} AS DOUBLE) AS consumption, {_GAP} AS read_interval
    FROM t_readings {_METER_WINDOW}"""

# Billing. ``one_meters`` has one register per meter, ``t_meters`` two for every tenth.
_ONE_METERS = "SELECT * FROM t_meters WHERE register = '001'"
_ROUND = "CAST(round(CAST({} AS DECIMAL(38,8)), 2) AS DOUBLE)"


def _round(expression: str) -> str:
    return _ROUND.format(expression)


def _last_bill(meters: str, registers: bool, bills: str = "t_bills") -> str:
    same = "AND m.installation = b.installation AND m.register = b.register" if registers else ""
    return f"""
    SELECT m.meter_id, m.bp, m.ccn, max(b.meter_reading_time) AS last_read_time
    FROM {bills} b JOIN {meters} m ON m.meter_id = b.meter_id {same} WHERE b.reason = '01'
    GROUP BY ALL"""


def _stats(
    meters: str, registers: bool, after: str, schedule_day: str | None, bills: str = "t_bills"
) -> str:
    same = "AND m.installation = b.installation AND m.register = b.register" if registers else ""
    schedule = next_date = ""
    if schedule_day:
        next_date = ", n.next_read_date"
        schedule = f"""JOIN (
            SELECT unit, min(read_date) AS next_read_date FROM t_segment_schedule
            WHERE read_date >= DATE '{schedule_day}' GROUP BY unit) n ON n.unit = b.unit"""
    return f"""
    SELECT *, CASE WHEN total_days > 0 THEN CAST(total_consumption AS DOUBLE) / total_days ELSE 0 END
               AS per_day
    FROM (
        SELECT m.meter_id, m.bp, m.ccn, m.register {next_date},
            sum(consumption_gl) AS total_consumption, avg(CAST(consumption_gl AS DOUBLE)) AS mean,
            stddev_pop(CAST(consumption_gl AS DOUBLE)) AS dev,
            min(meter_reading_time) AS start_date, max(meter_reading_time) AS end_date,
            CAST(extract('day' FROM max(meter_reading_time) - min(meter_reading_time)) AS INTEGER)
                AS total_days
        FROM {bills} b JOIN {meters} m ON m.meter_id = b.meter_id {same} {schedule}
        WHERE b.reason = '01' AND b.meter_reading_time > {after} GROUP BY ALL)"""


_ALL_TIME = "TIMESTAMP '2001-08-02' - INTERVAL 120 MONTH"
_PAST_YEAR = "TIMESTAMP '2001-06-01' - INTERVAL 15 MONTH"
_ACCOUNT_JOIN = "{0}.meter_id = ltrim(u.equipmentnumber, '0') AND {0}.bp = u.bp AND {0}.ccn = u.ccn"


def _high_usage(meters: str) -> str:
    return f"""
    SELECT u.bp AS businesspartnernumber, u.ccn AS contractaccount,
        ltrim(u.equipmentnumber, '0') AS equipmentnumber, b.last_read_time,
        CAST(sum(u.consumption) AS DOUBLE) AS current_usage, s.high_usage_limit
    FROM t_usage u JOIN bill b ON {_ACCOUNT_JOIN.format("b")}
    JOIN (SELECT *, {_round("mean + 2.5 * dev")} AS high_usage_limit FROM stats) s
        ON {_ACCOUNT_JOIN.format("s")}
    WHERE u.reading_datetime > b.last_read_time
    GROUP BY u.bp, u.ccn, u.equipmentnumber, b.last_read_time, s.high_usage_limit
    HAVING s.high_usage_limit < sum(u.consumption) AND sum(u.consumption) > 3000"""


def _projection() -> str:
    return f"""
    SELECT bp AS business_partner_number, premise_id, ccn AS connection_contract_number, meter_id,
        CAST(CAST(last_read_time AS DATE) AS TIMESTAMP) AS service_period_start,
        CAST(next_read_date AS TIMESTAMP) AS service_period_end,
        CAST(used AS DOUBLE) AS curr_read_consumption,
        CAST(CAST(latest AS DATE) AS TIMESTAMP) AS curr_read_date,
        {_round("per_day")} AS per_day_consumption, days AS days_to_next_read,
        CAST(used + round(CAST(days * per_day AS DECIMAL(38,8)), 2) AS DOUBLE) AS projected_consumption
    FROM (
        SELECT u.bp, p.premise_id, u.ccn, ltrim(u.equipmentnumber, '0') AS meter_id, b.last_read_time,
            s.next_read_date, s.per_day, sum(u.consumption) AS used, max(u.reading_datetime) AS latest,
            CAST(extract('day' FROM CAST(s.next_read_date AS TIMESTAMP) - max(u.reading_datetime))
                AS INTEGER) AS days
        FROM t_usage u JOIN bill b ON {_ACCOUNT_JOIN.format("b")}
        JOIN stats s ON {_ACCOUNT_JOIN.format("s")}
        JOIN (SELECT CAST(c_custkey AS VARCHAR) AS bp, CAST(c_custkey + 500000 AS VARCHAR) AS ccn,
                     'P' || c_custkey AS premise_id FROM customer) p ON p.bp = u.bp AND p.ccn = u.ccn
        WHERE u.reading_datetime > b.last_read_time
        GROUP BY u.bp, p.premise_id, u.ccn, u.equipmentnumber, b.last_read_time, s.per_day,
                 s.next_read_date)"""


_BILLING = ("t_register", "t_meters", "t_bills", "t_usage", "t_segment_schedule")
_HIGH_STEPS = {
    "one_meters": _ONE_METERS,
    "bill": _last_bill("one_meters", True),
    "stats": _stats("one_meters", True, _ALL_TIME, "2001-08-02"),
}
_TWO_BILLS = """SELECT * FROM t_bills
    UNION ALL SELECT * REPLACE ('002' AS register) FROM t_bills WHERE CAST(meter_id AS BIGINT) % 10 = 0"""
_HIGH_PARITY_STEPS = {
    "two_bills": _TWO_BILLS,
    "bill": _last_bill("t_meters", True, "two_bills"),
    "stats": _stats("t_meters", True, _ALL_TIME, "2001-08-02", "two_bills"),
}
_PROJECTED_STEPS = {
    "one_meters": _ONE_METERS,
    "bill": _last_bill("one_meters", False),
    "stats": _stats("one_meters", False, _PAST_YEAR, "2001-06-01"),
}
_PROJECTED_PARITY_STEPS = {
    "bill": _last_bill("t_meters", False),
    "stats": _stats("t_meters", False, _PAST_YEAR, "2001-06-01"),
}
_WITH_REGISTER = "SELECT *, '001' AS register FROM"

# Two registers with bills and usage of their own: the statements of one register, by register.
_APART_BILLS = """SELECT * FROM t_bills UNION ALL
    SELECT * REPLACE ('002' AS register, CAST(consumption_gl AS DECIMAL(18,6)) / 2 AS consumption_gl)
    FROM t_bills WHERE CAST(meter_id AS BIGINT) % 10 = 0"""
_APART_USAGE = """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS equipmentnumber,
        CAST(o_custkey AS VARCHAR) AS bp, CAST(o_custkey + 500000 AS VARCHAR) AS ccn,
        l_shipdate AS reading_datetime, CAST(l_extendedprice AS DECIMAL(18,2)) AS consumption,
        CASE WHEN o_custkey % 10 = 0 AND o_orderkey % 2 = 1 THEN '002' ELSE '001' END AS register
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_BY_REGISTER = ("t_register", "t_meters", "t_bills", "t_segment_schedule")


def _registers(sql: str) -> str:
    same = _ACCOUNT_JOIN.format("s")
    return sql.replace(same, f"{same} AND s.register = u.register").replace("FROM t_usage u", "FROM apart_usage u")


def _high_registers() -> str:
    sql = _registers(_high_usage("t_meters")).replace("SELECT u.bp", "SELECT u.register, u.bp", 1)
    return sql.replace("GROUP BY u.bp", "GROUP BY u.register, u.bp")


def _projected_registers() -> str:
    sql = _registers(_projection()).replace("SELECT bp AS", "SELECT register, bp AS", 1)
    return sql.replace("SELECT u.bp", "SELECT u.register, u.bp").replace("GROUP BY u.bp", "GROUP BY u.register, u.bp")


def _stats_by_register(after: str, day: str) -> str:
    sql = _stats("t_meters", False, after, day, "apart_bills")
    return sql.replace("m.meter_id = b.meter_id", "m.meter_id = b.meter_id AND m.register = b.register")

_LEAKS = """
    SELECT CAST(user_id AS VARCHAR) AS businesspartnernumber,
           CAST(user_id + 500000 AS VARCHAR) AS contractaccount
    FROM events WHERE ts > TIMESTAMP '2024-01-30' - INTERVAL 24 HOUR
    GROUP BY user_id HAVING min(CAST(value AS DECIMAL(18,4))) > 5"""


def _payload(bp: str, account: str) -> str:
    return (
        f"""'{{"businessPartnerNumber":"' || {bp} || '","contractAccountNumber":"' || {account} || """
        """'","alertDateTime":"2024-01-31T06:30:15Z"}'"""
    )


_NEXT_READ = """
    SELECT CAST(o_custkey AS VARCHAR) AS meter_reading_unit,
           CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS next_read_date
    FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY o_custkey"""

_WHOLE_HOURLY = VIEWS["hourly_tmp"].replace("2024-01-18", "2024-01-13")
_RELOAD_LAST = _DAILY_LAST.replace("2023-11-19", "2024-01-05")
# Backfills, as they are published.
_BACKFILL = "headend_meter_id, reading_datetime, register, consumption"

_MART_IDS = "* REPLACE (CAST(installation AS VARCHAR) AS installation, " \
    "CAST(contractaccount AS VARCHAR) AS contractaccount, CAST(contract AS VARCHAR) AS contract)"


def oracle_sql() -> dict[str, str]:
    readings = ("t_readings",)
    hourly = (*readings, *_MASTER, "hourly_tmp")
    backfill = (*readings, *_MASTER, "backfill_tmp")
    in_districts = "c.district IN ('NATION_0', 'NATION_1')"
    no_type = "'BACKFILL' AS read_interval_type, "
    both = f"""SELECT *, NULL AS utilities_premise FROM ({_HOURLY})
        UNION ALL BY NAME SELECT * FROM ({_HOURLY_ACCOUNT})"""
    out = {
        "interval_delta": _with(readings, _INTERVAL_DELTA),
        "interval_delta_digits": f"""
            SELECT meter_id, reading_datetime, CAST(reading_value AS DOUBLE) AS reading_value,
                CAST({_DELTA} AS DOUBLE) AS consumption, {_GAP} AS read_interval
            FROM (SELECT CAST(user_id AS VARCHAR) AS meter_id, ts AS reading_datetime,
                      CAST(value AS DECIMAL(18,2)) + CAST(event_id * 0.000001 AS DECIMAL(18,6)) AS reading_value
                  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY
                      CAST(value AS DECIMAL(18,2)) + CAST(event_id * 0.000001 AS DECIMAL(18,6)) DESC) = 1)
            {_METER_WINDOW}""",
        "dedupe_delta": _with(readings, _INTERVAL_DELTA),
        "dedupe_delta_parity": _with(
            (*readings, "doubled_tmp"), f"SELECT DISTINCT {_PLAIN_DELTA} FROM doubled_tmp"
        ),
        "reads_horizon": _with(
            readings,
            f"""SELECT {_PLAIN_READING} FROM t_readings
            WHERE reading_datetime BETWEEN TIMESTAMP '2024-01-18' AND TIMESTAMP '2024-01-21'""",
        ),
        "reads_backfill": _with(
            readings,
            f"SELECT {_PLAIN_READING} FROM t_readings WHERE reading_datetime > TIMESTAMP '2024-01-10'",
        ),
        "last_per_day": _with(
            readings, f"SELECT {_PLAIN_READING} FROM last_row", last_row=_LAST.format(where="")
        ),
        "max_ts_per_day": _with(
            readings,
            """SELECT meter_id, CAST(CAST(reading_datetime AS DATE) AS TIMESTAMP) AS reading_day,
            max(reading_datetime) AS reading_datetime FROM t_readings
            GROUP BY meter_id, CAST(reading_datetime AS DATE)""",
        ),
        "daily_delta": _with(
            readings,
            f"SELECT {_PLAIN_DELTA} FROM daily_tmp",
            last_row=_LAST.format(where=""),
            daily_tmp=_DAY_DELTA,
        ),
        "mart_row_coercion": _with(
            readings,
            f"""SELECT meter_id, reading_datetime, reading_value,
            coalesce(consumption, 0) AS consumption, coalesce(read_interval, 0) AS read_interval,
            CAST(CAST(meter_id AS BIGINT) AS VARCHAR) AS installation FROM ({_INTERVAL_DELTA})""",
        ),
        "valid_at": """
            SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS valid_from,
                CAST(CAST(o_orderdate AS DATE) + 90 AS TIMESTAMP) AS valid_to
            FROM orders
            WHERE DATE '1998-06-30' BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 90""",
        "validity_overlaps": """
            WITH orders_valid AS (
                SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 90 AS b
                FROM orders)
            SELECT o_custkey, o_orderkey, CAST(a AS TIMESTAMP) AS valid_from, CAST(b AS TIMESTAMP) AS valid_to
            FROM orders_valid x WHERE EXISTS (
                SELECT 1 FROM orders_valid y WHERE y.o_custkey = x.o_custkey AND y.o_orderkey <> x.o_orderkey
                AND y.a <= x.b AND x.a <= y.b)""",
        "reload_daily": _with(
            (*readings, *_MASTER),
            f"""SELECT equipmentnumber, register, CAST(contractaccount AS VARCHAR) AS contractaccount,
            count(*) AS days, count(consumption) AS deltas,
            CAST(sum(CAST(consumption AS DECIMAL(18,2))) AS DOUBLE) AS usage FROM ({_DAILY}) GROUP BY ALL""",
            last_row=_RELOAD_LAST,
            daily_tmp=_DAY_DELTA,
        ),
        "incremental_equals_whole": _with(
            (*readings, *_MASTER),
            f"""SELECT {_MART_IDS} FROM (
                SELECT *, NULL AS utilities_premise, 'customer' AS feed FROM ({_HOURLY})
                UNION ALL BY NAME SELECT *, 'account' AS feed FROM ({_HOURLY_ACCOUNT}))""",
            hourly_tmp=_WHOLE_HOURLY,
        ),
        "run_all_steps": _with(
            (*readings, *_MASTER, "hourly_tmp", "backfill_tmp"),
            f"""SELECT 'check' AS run_id, step, n AS rows, TIMESTAMP '2024-01-20 12:00:00' AS finished_at FROM (
                SELECT 'hourly' AS step, count(*) AS n FROM ({_HOURLY})
                UNION ALL SELECT 'daily', count(*) FROM ({_DAILY})
                UNION ALL SELECT 'hourly_account', count(*) FROM ({_HOURLY_ACCOUNT})
                UNION ALL SELECT 'daily_account', count(*) FROM ({_DAILY_ACCOUNT})
                UNION ALL SELECT 'next_read', count(*) FROM segments
                UNION ALL SELECT 'projection', count(*) FROM used
                UNION ALL SELECT 'high_usage', count(*) FROM used WHERE register = '001' AND total > 1
                UNION ALL SELECT 'leaks', count(*) FROM steady
                UNION ALL SELECT 'audit', (SELECT count(*) FROM used WHERE register = '001' AND total > 1)
                    + (SELECT count(*) FROM steady)
                UNION ALL SELECT 'backfill', (SELECT count(*) FROM (
                        {_reads("BACKFILL", "backfill_tmp", _BY_LOCATION, _LOCATION)} WHERE {in_districts}))
                    + (SELECT count(*) FROM ({_DAILY.replace("daily_tmp", "backfill_days")} WHERE {in_districts})))""",
            **_DAILY_STEPS,
            backfill_last=_LAST.format(where="WHERE reading_datetime > TIMESTAMP '2024-01-10'"),
            backfill_days=_DAY_DELTA.replace("last_row", "backfill_last"),
            segments="""SELECT DISTINCT c_mktsegment FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
                WHERE CAST(l_shipdate AS DATE) + 365 * 24 >= DATE '2024-01-20'""",
            used=f"""SELECT equipmentnumber, register, sum(CAST(consumption AS DECIMAL(18,2))) AS total
                FROM (SELECT * FROM ({_DAILY}) UNION ALL BY NAME SELECT * FROM ({_DAILY_ACCOUNT}))
                JOIN customer ON ltrim(equipmentnumber, '0') = CAST(c_custkey AS VARCHAR)
                JOIN segments USING (c_mktsegment)
                WHERE c_nationkey % 5 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
                AND reading_datetime > TIMESTAMP '2024-01-10' - to_days(CAST(c_custkey % 200 AS INTEGER))
                GROUP BY ALL""",
            steady=f"""SELECT businesspartnernumber, contractaccount
                FROM (SELECT * FROM ({_HOURLY}) UNION ALL BY NAME SELECT * FROM ({_HOURLY_ACCOUNT}))
                WHERE reading_datetime > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 40 HOUR
                GROUP BY ALL HAVING min(consumption) > -1""",
        ),
        "rejected_rows": """
            WITH raw AS (
                SELECT event_id, concat_ws('; ',
                    CASE WHEN event_id % 83 = 0 THEN 'meter_id: missing' END,
                    CASE WHEN event_id % 97 = 0 THEN 'reading_value: n/a' END,
                    CASE WHEN event_id % 89 = 0 THEN 'reading_datetime: soon' END) AS reason
                FROM events)
            SELECT 'customer_readings' AS "table", reason, CAST(event_id AS VARCHAR) AS event FROM raw WHERE reason <> ''
            UNION ALL SELECT 'customer_readings', 'fits', CAST(count(*) AS VARCHAR) FROM raw WHERE reason = ''""",
        "leading_zero_join": _with(
            ("t_register", "t_device"),
            """SELECT equipmentnumber, register, o_orderkey FROM t_device
            JOIN orders ON ltrim(equipmentnumber, '0') = CAST(o_custkey AS VARCHAR)""",
        ),
        "hourly_enriched": _with(hourly, _HOURLY),
        "hourly_enriched_parity": _with(
            (*readings, *_MASTER),
            _HOURLY,
            hourly_tmp=VIEWS["hourly_tmp"].replace(
                "FROM t_readings", "FROM (SELECT * FROM t_readings UNION ALL SELECT * FROM t_readings)"
            ),
        ),
        "hourly_enriched_ports": _with(
            (*_MASTER,), _HOURLY, t_readings=_PORTS, hourly_tmp=_by_port(VIEWS["hourly_tmp"])
        ),
        "daily_enriched_ports": _with(
            (*_MASTER,), _DAILY, t_readings=_PORTS, last_row=_by_port(_DAILY_LAST), daily_tmp=_by_port(_DAY_DELTA)
        ),
        "account_parity": _with(
            hourly,
            f"SELECT * FROM ({_HOURLY_ACCOUNT}) UNION ALL BY NAME SELECT * FROM ({_DAILY_ACCOUNT_PARITY})",
            last_row=_DAILY_LAST,
        ),
        "hourly_enriched_account": _with(hourly, _HOURLY_ACCOUNT),
        "daily_enriched": _with((*readings, *_MASTER), _DAILY, **_DAILY_STEPS),
        "daily_enriched_parity": _with((*readings, *_MASTER), _DAILY_PARITY, last_row=_DAILY_LAST),
        "daily_enriched_account": _with((*readings, *_MASTER), _DAILY_ACCOUNT, **_DAILY_STEPS),
        "district_reads": _with(hourly, f"{_HOURLY} WHERE {in_districts}"),
        "backfill_hourly": _with(
            backfill,
            _reads("BACKFILL", "backfill_tmp", _BY_LOCATION, _LOCATION).replace(no_type, "")
            + f" WHERE {in_districts}",
        ),
        "backfill_daily": _with(
            (*readings, *_MASTER),
            _DAILY.replace("'DAILY' AS read_interval_type, ", "") + f" WHERE {in_districts}",
            last_row=_LAST.format(where="WHERE reading_datetime > TIMESTAMP '2024-01-10'"),
            daily_tmp=_DAY_DELTA,
        ),
        "combined_reads": _with(hourly, both),
        "reads_row_counts": _with(
            hourly,
            f"""SELECT read_interval_type, count(*) AS rows_loaded
            FROM (SELECT read_interval_type FROM ({both})
                  UNION ALL SELECT read_interval_type FROM ({_DAILY}))
            GROUP BY read_interval_type""",
            **_DAILY_STEPS,
        ),
        "presorted_reads": _with(hourly, f"{_HOURLY} ORDER BY headend_meter_id, reading_datetime, register"),
        "last_bill": _with(
            ("t_register", "t_meters", "t_bills"),
            """SELECT meter_id, bp AS business_partner_number, ccn AS connection_contract_number,
            last_read_time FROM bill""",
            bill=_last_bill("t_meters", False),
        ),
        "billing_stats": _with(
            ("t_register", "t_meters", "t_bills"),
            f"""SELECT meter_id, bp AS business_partner_number, ccn AS connection_contract_number,
            register, CAST(total_consumption AS DOUBLE) AS total_consumption,
            {_round("mean")} AS avg_consumption, {_round("dev")} AS std_dev_consumption,
            {_round("mean + 2.5 * dev")} AS high_usage_limit, total_days, start_date, end_date,
            {_round("per_day")} AS per_day_consumption FROM stats""",
            one_meters=_ONE_METERS,
            stats=_stats("one_meters", False, _ALL_TIME, None),
        ),
        "billing_stats_digits": f"""
            SELECT CAST(o_custkey AS VARCHAR) AS meter_id, count(*) AS _n,
                {_round("stddev_pop(o_orderkey % 7)")} AS std_dev_millionths
            FROM orders WHERE o_orderdate > {_ALL_TIME} GROUP BY o_custkey""",
        "usage_since_bill": _with(
            _BILLING,
            f"""SELECT b.meter_id, b.bp AS business_partner_number, b.ccn AS connection_contract_number,
            b.last_read_time, CAST(sum(u.consumption) AS DOUBLE) AS current_usage,
            max(u.reading_datetime) AS last_reading
            FROM t_usage u JOIN bill b ON {_ACCOUNT_JOIN.format("b")}
            WHERE u.reading_datetime > b.last_read_time GROUP BY ALL""",
            bill=_last_bill("t_meters", False),
        ),
        "high_usage": _with(
            _BILLING, f"{_WITH_REGISTER} ({_high_usage('one_meters')})", **_HIGH_STEPS
        ),
        "high_usage_registers": _with(
            _BY_REGISTER,
            _high_registers(),
            apart_bills=_APART_BILLS,
            apart_usage=_APART_USAGE,
            bill=_last_bill("t_meters", True, "apart_bills"),
            stats=_stats_by_register(_ALL_TIME, "2001-08-02"),
        ),
        "projected_consumption_registers": _with(
            _BY_REGISTER,
            _projected_registers(),
            apart_bills=_APART_BILLS,
            apart_usage=_APART_USAGE,
            bill=_last_bill("t_meters", False, "apart_bills"),
            stats=_stats_by_register(_PAST_YEAR, "2001-06-01"),
        ),
        "high_usage_parity": _with(_BILLING, _high_usage("t_meters"), **_HIGH_PARITY_STEPS),
        "next_read": _NEXT_READ,
        "projected_consumption": _with(
            _BILLING, f"{_WITH_REGISTER} ({_projection()})", **_PROJECTED_STEPS
        ),
        "projected_consumption_parity": _with(_BILLING, _projection(), **_PROJECTED_PARITY_STEPS),
        "leak_alerts": _LEAKS,
        "alert_payload": f"""
            SELECT 'leak-alert' AS event_type, 'https://alerts.example.org/api/leak-alert' AS target,
                {_payload("businesspartnernumber", "contractaccount")} AS payload,
                businesspartnernumber, contractaccount, TIMESTAMP '2024-01-31' AS run_date
            FROM ({_LEAKS})""",
        "audit_records": _with(
            _BILLING,
            f"""SELECT 'check' AS source_hostname, 'high-usage-alert' AS event_type,
            '{{}}' AS event_result, 'HTTP/1.1 200 OK' AS event_result_info1, 'OK' AS event_extra_info1,
            {_payload("businesspartnernumber", "contractaccount")} AS event_extra_info2,
            'https://alerts.example.org/api/high-usage-alert' AS event_extra_info3,
            businesspartnernumber, contractaccount, equipmentnumber, last_read_time,
            current_usage AS sum_consumption, current_usage, high_usage_limit,
            TIMESTAMP '2024-01-31 06:30:15' AS created_at
            FROM ({_high_usage("one_meters")})""",
            **_HIGH_STEPS,
        ),
        "alerts_rerun": f"""
            SELECT 'leak-alert' AS event_type, 'https://alerts.example.org/api/leak-alert' AS target,
                {_payload("businesspartnernumber", "contractaccount").replace("2024-01-31T06:30:15Z", "2024-01-30T00:00:00Z")}
                    AS payload,
                businesspartnernumber, contractaccount, TIMESTAMP '2024-01-30' AS run_date
            FROM ({_LEAKS})""",
        "append_reads": _with(
            hourly,
            f"""SELECT {_MART_IDS}, 'customer' AS feed
            FROM (SELECT * FROM ({_HOURLY}) UNION ALL SELECT * FROM ({_HOURLY}))""",
        ),
        "mart_both_feeds": _with(
            hourly,
            f"""SELECT {_MART_IDS} FROM (
                SELECT *, NULL AS utilities_premise, 'customer' AS feed FROM ({_HOURLY})
                UNION ALL BY NAME SELECT *, 'account' AS feed FROM ({_HOURLY_ACCOUNT}))""",
        ),
        "replace_slice": _with(
            hourly,
            f"""SELECT {_MART_IDS}, 'customer' AS feed
            FROM (SELECT * FROM ({_HOURLY}) UNION ALL SELECT * FROM ({_DAILY}))""",
            **_DAILY_STEPS,
        ),
        "replace_all": _NEXT_READ,
        "overwrite_if_any": _NEXT_READ,
        "publish_versions": _with(
            (*readings, *_MASTER, "backfill_tmp"),
            f"""SELECT 'hourly' AS mart, {_BACKFILL}
                FROM ({_reads("BACKFILL", "backfill_tmp", _BY_LOCATION, _LOCATION)} WHERE {in_districts})
            UNION ALL SELECT 'daily', {_BACKFILL} FROM ({_DAILY} WHERE {in_districts})
            UNION ALL SELECT 'next_read', meter_reading_unit, next_read_date, NULL, NULL FROM ({_NEXT_READ})""",
            last_row=_LAST.format(where="WHERE reading_datetime > TIMESTAMP '2024-01-10'"),
            daily_tmp=_DAY_DELTA,
        ),
        "export_csv": _with(readings, f"SELECT {_PLAIN_READING} FROM t_readings"),
    }
    out["audit_duplicates"] = out["audit_records"]
    return out
