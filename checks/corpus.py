"""Defect texts derived from the test tables.

The tables hold no defect vocabulary, so texts are composed from table rows. Each corpus is
one SQL expression per row, in the SQL that Spark and DuckDB share, so both engines build the
same text and neither groups or collects rows. ``~`` stands for a newline in the pools.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.sources.inventory import storage
from bugsieve.sources.spread import spread
from bugsieve.sources.staging import metadata

# The pools are written from the rule table: each entry names the rules it is meant to hit, and
# entries marked "near" miss a rule by a little.
SERVICES = [
    "tide-gauge", "ferry-ticket-service", "kiln", "seed-vault", "lamp-dimmer-service",
    "7dome", "orchard-map", "ink_press", "bell-tower-service", "glass house",
]

MESSAGES = [
    "Screen  reader skips a heading, an error of the tide table",  # ET-S03
    "screen reader of the old kind",  # near ET-S03
    "NVDA announcing each wave as a button",  # ET-S04
    "VoiceOver not  announcing the ferry times. Muted",  # ET-S04
    "JAWS stays silent",  # near ET-S04
    "accessibility problem with the ramp plan. Noted",  # ET-S05
    "Accessibility review is due",  # near ET-S05
    "program fails to launch at dusk. Lamps stay off",  # ET-S06
    "Application fail to open the dome",  # ET-S06
    "program fails at launch",  # near ET-S06
    "npe while folding a map, then nullpointerexception",  # ET-S07
    "NPEs counted, NullPointerExceptions too",  # near ET-S07
    "IndexOutOfBoundsException behind row 9 of the seed list",  # ET-S08
    "sqlexception from the ink ledger",  # ET-S09
    "MySQLException is another word",  # near ET-S09
    "TimeoutException, TimeoutException again",  # ET-S10 twice
    "ConnectionRefusedException at the east pier",  # ET-S11
    "FileNotFoundException: plan.dxf",  # ET-S12
    "kiln is out of memory, OutOfMemoryError raised, out of memory",  # ET-S13 three times
    "StackOverflowError in the tree walk",  # ET-S14
    "answer 502 error from the harbour, then 500 Internal Server Error",  # ET-S15 twice
    "507 Timeouts and a 599 of unknown kind",  # near ET-S15
    "code 401 Unauthorized for the night shift",  # ET-S16
    "404 was not found in the index",  # near ET-S16
    "connection  pool exhausted by the morning queue",  # ET-S17
    "connection timeout to buoy 12",  # ET-S18
    "circuit breaker triggered by the pump",  # ET-S19
    "circuit breakers triggered",  # near ET-S19
    "service dependency unresponsive: weather feed",  # ET-S20
    "memory usage critical in the mixer",  # ET-S21
    "memory usage is fine",  # near ET-S21
    "memory leak  detected near the loom",  # ET-S22
    "a cascade failure of three weirs",  # ET-S23
    "database connection failed, database connection timeout",  # ET-S24 twice
    "endpoint timeout detected at gate 4",  # ET-S25
    "request processing failed for berth 3",  # ET-S26
    "health changed to degraded at lock two",  # ET-S27
    "healthy, then degraded",  # near ET-S27
    "queue overflow of parcels",  # ET-S28
    "error rate exceeded threshold of the sluice. Gates held",  # ET-L02
    "failed to ring the bell: rope missing",  # ET-L03
    "unable to read the dial, unable to wind the clock",  # ET-L04 twice
    "pump timed out, timeout, time out",  # ET-L05 three times
    "the crash of a shelf, a failure of glue",  # ET-L06
    "pier light degraded",  # ET-L07
    "website https://tides.example.org/now was slow",  # CM-S05
    "portal: http://seeds.example.com",  # CM-S05
    "unresponsive: lantern-service, unavailable  rope-walk-service",  # CM-S09 twice
    "weir-gate-service  unresponsive since noon",  # CM-S10
    "services degraded: oven-north, oven-south",  # CM-S11
    "in module orchard.graft the ladder is short",  # CM-S12
    "stuck at dome.shutter.Motor.turn(step 4)",  # CM-S13
    "a jam in the FerryScheduleManager, seen by TideHandler",  # CM-S14, CM-L05, CM-L06
    "component 'roof_vent' rattles",  # CM-S15
    "moss-and-fern-service hums, salt--service does not",  # CM-L01, near CM-L01
    "kite-reel status unknown, kite-reel  degraded",  # CM-L02 twice
    "LoomService idle, PressController idle",  # CM-L03, CM-L04
    "upstream service: rain-gauge, backend service wind-vane",  # CM-L07 twice
    "user impact: 3 anglers wait",  # OB-S03
    "19 users affected by fog, 1 user affected by rain",  # OB-S04 twice
    "service is down, service unavailable after that",  # OB-L05 twice
    "sla: 30 trays an hour, limit 4",  # EX-L04 twice
    "all lamps lit, nothing to add",
    "tide turned at 06:12",
]

BLOCKS = [
    "The gardener has nothing to say here.",
    "[Gate log]: The west gate stays open far too long after sunset",  # ET-S02
    "[Gate log]: The gate on time",  # near ET-S02
    "[Herb garden Service Now desk]: plants listed twice",  # CM-S01
    "[Rope walk] - spindle stuck",  # CM-S02 misses the closed bracket
    "[Rope walk - spindle] stuck",  # CM-S02
    "System: Tide Tables Version 9~Tool Kiln Control, second oven",  # CM-S03 twice
    "Screen readers: Orca 46 - on the kiosk",  # CM-S04
    "screen reader - Narrator 11: used at the pier",  # CM-S04
    "Steps to reproduce:~1. Turn the dial~2. Pull the lever~~After that a bell rings.",  # RS-S01, RS-S04
    "Repro step: fill the tank~actual level stays low",  # RS-S01 up to "actual"
    "reproduction steps wait for review",  # near RS-S01: no colon, but a space
    "How to reproduce  open the lock at low tide~~Then wait.",  # RS-S02
    "to reproduce: ring twice, expected one echo",  # RS-S02 up to "expected"
    "repro: leave the oven on overnight",  # RS-S03
    "reproach is not a step",  # near RS-S03
    " 1) Wet the clay~ 2) Spin the wheel~ 3) Fire it",  # RS-S04
    "1. Only a single step",  # near RS-S04
    "when accessing the attic a board creaks. Careful",  # RS-L01, RS-L02
    "visited the mill and clicking stops. Opened the sluice",  # RS-L02 three times
    "if you: lean on the rail it bends",  # RS-L03
    "[2031-02-03 04:05] INFO kettle on~[2031-02-03 04:06] WARN kettle dry~[2031-02-03 04:07] ERROR smoke",  # RS-L04
    "[2031-02-03 04:05] INFO a single entry",  # near RS-L04
    "Actual result: the raft drifts~~Expected result: the raft stays moored",  # OB-S01, EX-S01
    "What happened: ink ran dry~and paper tore~~Later on it was cleaned.",  # OB-S01
    "observed  behavior unclear, current behavior: door squeaks",  # OB-S01
    "Outcome: two eels caught~~Result - none",  # OB-S02
    "Customer impact: picnic moved indoors~4 users affected",  # OB-S03, OB-S04
    "note: CRITICAL [mill] wheel brake failed at noon. Stopped",  # OB-L01
    "The bridge lifts but: cars wait. However, boats pass",  # OB-L02
    "The panel displays: 77 degrees. It gives no unit, returns nothing",  # OB-L03
    "application crashes at moonrise. Twice",  # OB-L04
    "The hatch should be watertight~~No drops.",  # EX-S01
    "Acceptance criteria: bread has a crust~~Crumb is soft.",  # EX-S02
    "expected: calm sea",  # EX-S02
    "The clerk needs to process all stamps, must show each. Gates should close",  # EX-L01
    "We want: warmer soup. expecting a spoon",  # EX-L02
    "Normally, herons sleep. Ropes coil properly, as taught",  # EX-L03
    "threshold: 12 cups. Limit of 3",  # EX-L04
    "The SluiceController opens in the WeirGateModule",  # CM-S14, CM-L04
    "component: sun_dial~in module \"shade.plan\" a bolt is loose",  # CM-S15, CM-S12
]

TITLES = [
    "Connection timeout of the buoy in HarborService",  # ET-S18, CM-S14
    "FileNotFoundException in StampPrinter",  # ET-S12
    "StackOverflowError in MazeHandler",  # ET-S14, CM-S14
    "<em>Program fails to start</em> in winter",  # ET-S06
    "Level shown when x &lt; y &nbsp;on dial",
    "",
]

DESCRIPTIONS = [
    "<div>Visitors queue&nbsp;while the turnstile is degraded</div>",  # ET-L07
    "<p>The oven stops, but the timer runs</p>",  # OB-L02
    "",
    "<ol><li>Kites tangle</li><li>String snaps</li></ol> &lt;empty&gt;",
    "Service is unresponsive. <br>User impact: 8 users affected",  # OB-L05, OB-S03
]

REPRO = [
    "1. Row to the buoy~2. Tie the boat~3. Read the SQLException on the slip",  # RS-S04, ET-S09
    "1) Light the stove~2) Boil water~3) Hear the TimeoutException bell",  # RS-S04, ET-S10
    "",
    "Navigate to the lighthouse and climb",  # RS-L02
]

CRITERIA = [
    "Boat should return before dusk",  # EX-L01
    "",
    "Tea must be <i>hot</i>",  # EX-L01
]


def _pool(values: list[str], index: str) -> str:
    cases = " ".join(
        "WHEN {} THEN '{}'".format(i, v.replace("'", "''")) for i, v in enumerate(values)
    )
    return f"CASE ({index}) % {len(values)} {cases} END"


def _picked(values: list[str], index: str) -> str:
    """``_pool`` as Spark runs it: one lookup, where a CASE computes the index for every value."""
    quoted = ", ".join("'{}'".format(v.replace("'", "''")) for v in values)
    return f"get(array({quoted}), CAST(({index}) % {len(values)} AS INT))"


def _stamp(index: str) -> str:
    joint = f"CASE ({index}) % 5 WHEN 0 THEN ' ' ELSE 'T' END"
    day = f"lpad(CAST(1 + ({index}) % 27 AS STRING), 2, '0')"
    second = f"lpad(CAST(({index}) % 59 AS STRING), 2, '0')"
    return f"'[2031-06-' || {day} || {joint} || '21:40:' || {second} || 'Z] '"


def _line(level: str, a: int, b: int, pool: Callable[[list[str], str], str] = _pool) -> str:
    i = f"event_id * {a} + {b}"
    service = pool(SERVICES, f"event_id * {a + 2} + {b}")
    return f"{_stamp(i)} || {level} || ' [' || {service} || '] ' || {pool(MESSAGES, i)}"


_LEVEL_OF_TYPE = (
    "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'CRITICAL' "
    "WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END"
)
_LEVELS = ["INFO", "ERROR", "DEBUG", "WARN", "INFO", "CRITICAL", "WARN"]

# One log line per event.
LOG_LINE = _line(_LEVEL_OF_TYPE, 7, 3)


def _log_text(pool: Callable[[list[str], str], str]) -> str:
    return (
        f"replace({_line(_LEVEL_OF_TYPE, 7, 3, pool)}"
        f" || CASE WHEN event_id % 5 = 0 THEN '' ELSE '~' || {_line(pool(_LEVELS, 'event_id * 5'), 13, 5, pool)} END"
        f" || CASE WHEN event_id % 3 = 0 THEN '~' || {_line(pool(_LEVELS, 'event_id * 3 + 1'), 29, 11, pool)} ELSE '' END"
        f" || CASE WHEN event_id % 7 < 4 THEN '~' || {pool(BLOCKS, 'event_id * 17')} ELSE '' END"
        f", '~', chr(10))"
    )


# One short log per event: its own line, up to two more, and for some a free block.
LOG_TEXT = _log_text(_pool)

# A user's text followed by a block, for every turn of every conversation.
FREE_TEXT = f"replace(text || '~~' || {_pool(BLOCKS, 'conv_id * 7 + turn * 11')}, '~', chr(10))"

_TITLE = _pool(TITLES, "o_orderkey * 5 + 1")
_DESCRIPTION = _pool(DESCRIPTIONS, "o_orderkey * 3 + 2")
_REPRO = f"replace({_pool(REPRO, 'o_orderkey + o_custkey')}, '~', chr(10))"
_CRITERIA = _pool(CRITERIA, "o_orderkey * 7 + o_custkey")

# The four parts of a work item; every fifth order lacks the criteria altogether.
ITEM_PARTS = {
    "title": _TITLE,
    "description": _DESCRIPTION,
    "repro": _REPRO,
    "criteria": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_CRITERIA} END",
}
# Some inputs are not work items, some have no id.
ITEM_KIND = (
    "CASE WHEN o_orderkey % 101 = 7 THEN 'broken' WHEN o_orderkey % 103 = 5 THEN 'list' "
    "WHEN o_orderkey % 13 = 3 THEN 'noid' WHEN o_orderkey % 2 = 0 THEN 'number' ELSE 'string' END"
)

# Paths and sizes as a file listing would give them; a NULL size means no such file.
PATH_TEMPLATES = [
    "/data/in/{}.log", "/data/in/{}.txt", "/data/in/{}.PDF", "/data/in/{}.docx", "/data/in/{}.doc",
    "/data/in/{}.csv", "/data/in/{}", "/data/in/.log{}", "in/sub/{}.pdf", "in/../../etc/{}.log",
    "/data/./in/../in/{}.EXE", "/data2/in/{}.txt", "in/{}.tar.sh", "/data/in/{}.",
]
# Whether each template stays inside /data and is safe, in the order above.
PATH_SAFE = [True, True, True, True, True, True, True, True, True, False, False, False, False, True]
FILE_PATH = "replace({}, '{{}}', CAST(o_orderkey AS STRING))".format(
    _pool(PATH_TEMPLATES, "o_orderkey")
)
FILE_SIZE = (
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 52428801 + o_orderkey "
    "ELSE 1000 + o_orderkey END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", f"{LOG_LINE} AS line")


def as_logs(events: DataFrame) -> DataFrame:
    """Staging frame of short logs from event rows, batch or streaming."""
    texts = events.selectExpr("event_id", "ts", "user_id", f"{_log_text(_picked)} AS text")
    source_id = F.concat(F.lit("log_"), F.col("event_id").cast("string"))
    return texts.select(
        "text",
        metadata("error_log", source_id, F.col("text")).alias("source_metadata"),
        "event_id", "ts", "user_id",
    )


def spread_scan(scan: DataFrame, thin: bool = True) -> DataFrame:
    """The scan over as many partitions as the session asks for.

    The benchmark names its cores, since each table is one file there. Where none are named, the scan
    of a thin table, whose rows hold a few numbers that long texts are composed from, goes over the
    session's shuffle partitions, four a core at least: its files are too small for their splits to
    keep all cores busy. Other scans are left unchanged.
    """
    wanted = scan.sparkSession.conf.get("spark.checks.inputPartitions", None)
    if wanted is None and thin:
        cores = scan.sparkSession.sparkContext.defaultParallelism
        wanted = max(4 * cores, int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread(scan, int(wanted) if wanted else None)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return as_logs(spread_scan(events))


def free_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return spread_scan(turns, thin=False).selectExpr("conv_id", "turn", f"{FREE_TEXT} AS text")


def item_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return spread_scan(orders).selectExpr(
        "o_orderkey", *[f"{sql} AS {name}" for name, sql in ITEM_PARTS.items()],
        f"{ITEM_KIND} AS kind",
    )


def work_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work items as the JSON text a tracker exports."""
    parts = item_parts(spark, sf_dir)
    fields = F.struct(
        F.col("title").alias("System.Title"),
        F.col("description").alias("System.Description"),
        F.col("repro").alias("Microsoft.VSTS.TCM.ReproSteps"),
        F.col("criteria").alias("Microsoft.VSTS.Common.AcceptanceCriteria"),
        F.lit("Active").alias("System.State"),
    )
    key = F.col("o_orderkey")
    json = (
        F.when(F.col("kind") == "broken", F.lit("{\"id\": 5, \"fields\": "))
        .when(F.col("kind") == "list", F.lit("[1, 2]"))
        .when(F.col("kind") == "noid", F.to_json(F.struct(fields.alias("fields"))))
        .when(F.col("kind") == "number", F.to_json(F.struct(key.alias("id"), fields.alias("fields"))))
        .otherwise(F.to_json(F.struct(key.cast("string").alias("id"), fields.alias("fields"))))
    )
    return parts.select("o_orderkey", json.alias("json"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{FILE_PATH} AS path", f"CAST({FILE_SIZE} AS BIGINT) AS length"
    )


def write_files(files: DataFrame, path: str) -> None:
    """Write each row (name, text) as a file of that name; tasks write, each file whole or not at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, inner, _ = storage(path)
                system.create_dir(inner, recursive=True)
                new = f"{inner}/.{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(new) as file:
                    file.write(text.encode())
                system.move(new, f"{inner}/{name}")
                written += 1
        yield pa.RecordBatch.from_pydict({"written": pa.array([written], type=pa.int64())})

    files.select("name", "text").mapInArrow(run, "written long").agg(F.sum("written")).collect()
