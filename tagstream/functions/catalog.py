"""Configuration tables: tag dictionary, threshold rules, alert rules, routes.

These are fixed inputs of the plant, kept as plain Python records and turned
into small literal DataFrames.  Their size is known on the driver, which is
what makes broadcasting them safe.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the plant configuration for right results)
#
# Signal tags of the simulated source, then process tag groups with their
# sizes.  Process tag names are "<group>_<NN>" with NN = 01..size.
# ---------------------------------------------------------------------------
SIGNAL_TAGS = ["Counter", "Random", "Sawtooth", "Sinusoid", "Square", "Triangle", "Constant"]

TAG_GROUPS = [
    ("Temp_Boiler", 20), ("Temp_HeatEx", 10), ("Press_Line", 20), ("Press_Tank", 10),
    ("Flow_Main", 15), ("Flow_Branch", 15), ("Level_Tank", 20), ("Vibration_Pump", 20),
    ("Power_Motor", 20), ("RPM_Motor", 20), ("Humidity_Room", 10), ("Current_Drive", 20),
    ("Voltage_Bus", 10), ("CO2_Zone", 10), ("Noise_Floor", 10), ("Torque_Motor", 20),
    ("Temp_Ambient", 10), ("Flow_Coolant", 10), ("Press_Hydraulic", 10), ("Temp_Oil", 10),
    ("Temp_Cooling", 10),
]

# OPC UA namespace index of the simulated server's tags, and the first numeric
# node id of the signal tags and of the process tags (both in dictionary order).
TAG_NAMESPACE = 3
FIRST_SIGNAL_NODE = 1001
FIRST_PROCESS_NODE = 2001


def plant_tags() -> list[str]:
    """The 307 tag names in dictionary order (7 signal + 300 process)."""
    names = list(SIGNAL_TAGS)
    for group, size in TAG_GROUPS:
        names.extend(f"{group}_{i:02d}" for i in range(1, size + 1))
    return names


@dataclass(frozen=True)
class Rule:
    """Threshold rule: first rule whose prefix starts the tag name applies."""

    prefix: str
    max: float | None
    min: float | None
    unit: str
    severity: str
    description: str


# FIXED VALUES: the plant's 19 threshold rules in evaluation order.
PLANT_RULES = [
    Rule("Temp_Boiler_", 95.0, None, "°C", "Critical",
         "Boiler temperature overheat — risk of pressure vessel failure"),
    Rule("Temp_HeatEx_", 80.0, None, "°C", "High",
         "Heat exchanger outlet temperature high — fouling or flow reduction"),
    Rule("Temp_Oil_", 85.0, None, "°C", "High",
         "Oil temperature high — lubrication degradation risk"),
    Rule("Temp_Cooling_", 30.0, None, "°C", "High",
         "Cooling water temperature high — cooling system performance degraded"),
    Rule("Vibration_Pump_", 10.0, None, "mm/s", "High",
         "Pump vibration excessive — bearing wear or misalignment"),
    Rule("Press_Line_", 8.0, 2.0, "bar", "High",
         "Line pressure out of safe range — check valves and pump"),
    Rule("Press_Tank_", 6.0, 1.0, "bar", "High",
         "Tank pressure out of safe range — check relief valve"),
    Rule("Press_Hydraulic_", 160.0, 50.0, "bar", "Critical",
         "Hydraulic pressure out of safe range — system integrity at risk"),
    Rule("Level_Tank_", 90.0, 10.0, "%", "High",
         "Tank level out of safe range — overflow or dry-run risk"),
    Rule("Current_Drive_", 60.0, None, "A", "High",
         "Drive current high — motor overload or mechanical jam"),
    Rule("Torque_Motor_", 350.0, None, "Nm", "High",
         "Motor torque high — mechanical overload"),
    Rule("RPM_Motor_", 2200.0, 500.0, "rpm", "Medium",
         "Motor speed out of operating range"),
    Rule("Power_Motor_", 100.0, None, "kW", "Medium",
         "Motor power consumption high — efficiency loss"),
    Rule("Voltage_Bus_", 440.0, 350.0, "V", "Critical",
         "Bus voltage out of range — electrical system fault"),
    Rule("CO2_Zone_", 1000.0, None, "ppm", "Medium",
         "CO2 level high — ventilation insufficient"),
    Rule("Humidity_Room_", 80.0, 20.0, "%", "Medium",
         "Room humidity out of comfort/equipment range"),
    Rule("Flow_Main_", 160.0, 30.0, "m³/h", "High",
         "Main flow out of range — check pipeline and pump"),
    Rule("Flow_Branch_", 60.0, 10.0, "m³/h", "Medium",
         "Branch flow out of range"),
    Rule("Flow_Coolant_", 40.0, 10.0, "m³/h", "High",
         "Coolant flow out of range — cooling effectiveness compromised"),
]

# FIXED VALUES: severity → work-order priority.
PRIORITY = {"Critical": "1", "High": "2", "Medium": "3"}

# Seconds a tag stays quiet after it fired.
DEFAULT_COOLDOWN_SECONDS = 300

RULE_SCHEMA = T.StructType([
    T.StructField("rule_order", T.IntegerType(), False),
    T.StructField("prefix", T.StringType(), False),
    T.StructField("max_val", T.DoubleType(), True),
    T.StructField("min_val", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])


def rules_df(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    """ALM1: the ordered rule list as a literal DataFrame (rule_order from 1)."""
    rules = PLANT_RULES if rules is None else rules
    rows = [(i + 1, r.prefix, r.max, r.min, r.unit, r.severity, r.description)
            for i, r in enumerate(rules)]
    # from Arrow the list becomes a local relation, whose size Spark knows when it picks a join
    cols = list(zip(*rows)) or [()] * len(RULE_SCHEMA)
    return spark.createDataFrame(pa.table(
        [pa.array(c, t) for c, t in zip(cols, to_arrow_schema(RULE_SCHEMA).types)], names=RULE_SCHEMA.names), RULE_SCHEMA)


def tag_dictionary_df(spark: SparkSession, tags: list[str] | None = None,
                      namespace: int = TAG_NAMESPACE) -> DataFrame:
    """Tag dictionary rows (tag_order, tag_name, namespace, node_id).

    Node ids are numeric: signal tags and process tags count up separately."""
    tags = plant_tags() if tags is None else tags
    signals = [t for t in tags if t in SIGNAL_TAGS]
    process = [t for t in tags if t not in SIGNAL_TAGS]
    number = ({t: FIRST_SIGNAL_NODE + i for i, t in enumerate(signals)}
              | {t: FIRST_PROCESS_NODE + i for i, t in enumerate(process)})
    rows = [(i + 1, t, namespace, f"ns={namespace};i={number[t]}") for i, t in enumerate(tags)]
    return spark.createDataFrame(
        rows, "tag_order int, tag_name string, namespace int, node_id string")


@dataclass(frozen=True)
class AlertRule:
    """Hot-path alert rule evaluated every ``interval`` over ``range_``.

    ``field_regex`` selects the series (anchored regex on the field);
    ``measurement`` optionally restricts to a measurement. ``reducer`` is one
    of count, mean, max, min, last, sum. ``condition`` is ``(op, limit)``
    pairs OR-ed together, e.g. ``[(">", 160.0), ("<", 50.0)]``.
    """

    uid: str
    field_regex: str | None
    reducer: str
    range_: str
    condition: tuple
    for_: str
    severity: str
    no_data: str = "OK"
    measurement: str | None = None
    labels: dict = field(default_factory=dict)


# FIXED VALUES: the six provisioned alert rules (evaluated every 1 minute).
PLANT_ALERT_RULES = [
    AlertRule("opc_ingest_stopped", None, "count", "2 minutes", (("<", 1.0),), "1 minute",
              "critical", no_data="Alerting", measurement="opc_data"),
    # tag_count always equals the dictionary size: the rule watches
    # observed_count, the number of tags that actually delivered a value.
    AlertRule("opc_tag_count_low", "^observed_count$", "last", "5 minutes", (("<", 307.0),),
              "3 minutes", "warning", no_data="NoData"),
    AlertRule("opc_bad_value_high", "^bad_count$", "mean", "5 minutes", ((">", 10.0),),
              "5 minutes", "warning", no_data="OK"),
    AlertRule("boiler_temp_critical", "^Temp_Boiler_", "max", "2 minutes", ((">", 95.0),),
              "1 minute", "critical", no_data="OK", measurement="opc_data"),
    AlertRule("hydraulic_pressure_critical", "^Press_Hydraulic_", "last", "2 minutes",
              ((">", 160.0), ("<", 50.0)), "1 minute", "critical", no_data="OK"),
    AlertRule("vibration_high", "^Vibration_Pump_", "max", "5 minutes", ((">", 10.0),),
              "2 minutes", "warning", no_data="OK"),
]

EVAL_INTERVAL = "1 minute"


@dataclass(frozen=True)
class Route:
    """Notification policy: first route whose matchers all hold wins."""

    matchers: tuple  # (label, value) equality pairs
    receiver: str
    group_wait_s: int
    group_interval_s: int
    repeat_interval_s: int


# FIXED VALUES: notification routes, then the default policy.
PLANT_ROUTES = [
    Route((("severity", "critical"),), "email-default", 0, 300, 3600),
    Route((("severity", "warning"),), "email-default", 60, 300, 21600),
]
DEFAULT_ROUTE = Route((), "email-default", 30, 300, 14400)
GROUP_BY = ("alertname", "severity")

# FIXED VALUES: daily mute window, local time.
MUTE_WINDOWS = [("maintenance-window", "01:50", "02:30", "Asia/Bangkok")]

# FIXED VALUES: dashboard status colour steps (green below the first step).
STATUS_STEPS = {
    "cpu": (70.0, 90.0),
    "mem": (75.0, 90.0),
    "disk": (75.0, 90.0),
}

# FIXED VALUES: consumer lag bands.
LAG_NORMAL_BELOW = 10
LAG_CHECK_ABOVE = 1000

