"""Domain constants as data: status codes, the rule of each equipment family and sensor type, and the decision table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Status codes and their meaning.
STATUS = {1: "Funcionando OK", 2: "Baja presión", 3: "Sin funcionar", 4: "Temp crítica"}

# Sensor types, and the device types of each equipment family.
CURRENT, PRESSURE, TEMPERATURE, POWER, THERMOSTAT = "Corriente", "Presión", "Temperatura", "Encendido", "On/Off Termostato"
FAMILIES = {
    "maquinas_nieve": ["Máquina de nieve"],
    "maquinas_soda": ["Máquina de sodas"],
    "cuartos_refrigeracion": ["Cuarto de conservación", "Ambiente conservacion", "Compresor conservación"],
    "cuartos_congelacion": ["Cuarto de congelación", "Ambiente congelacion", "Compresor congelación", "Resitencia de deshielo", "Resistencia de deshielo"],
    "luces": ["Luminaria"],
    "termostatos": ["A/C de Cocina", "A/C de Comedor", "Ambiente playland"],
}
DEFROST = ["Resitencia de deshielo", "Resistencia de deshielo"]

# Fixed values: (rule, family, sensor type, windowed, least, most, window in minutes, value is the ok share, anomalies are kept).
RULES = [
    (1, "maquinas_nieve", CURRENT, True, 0.55, None, 20, False, True),
    (2, "maquinas_soda", CURRENT, True, 0.6, None, 20, False, True),
    (3, "maquinas_soda", PRESSURE, False, 20.0, None, None, False, True),
    (4, "cuartos_refrigeracion", TEMPERATURE, True, 34.0, 40.0, 240, False, True),
    (5, "cuartos_refrigeracion", CURRENT, False, 1.0, None, None, False, False),
    (6, "cuartos_congelacion", TEMPERATURE, True, -10.0, 0.0, 240, False, True),
    (7, "cuartos_congelacion", CURRENT, False, 1.0, None, None, False, False),
    (8, "luces", POWER, False, 1.0, None, None, True, False),
    (9, "termostatos", THERMOSTAT, False, 1.0, None, None, True, False),
    (10, "termostatos", TEMPERATURE, False, 66.0, None, None, False, False),
]

# Flags of current, pressure, temperature, power and thermostat (None: no reading) -> device status; all others give 3.
DECISIONS = [
    ((1, None, None, None, None), 1), ((1, 1, None, None, None), 1), ((1, 0, None, None, None), 2), ((1, None, 0, None, None), 4),
    ((1, None, 1, None, None), 1), ((None, None, 1, None, None), 1), ((None, None, 0, None, None), 4), ((None, None, None, 1, None), 1),
    ((1, None, None, 1, None), 1), ((0, None, None, 1, None), 1), ((None, None, 1, None, 1), 1), ((None, None, 0, None, 1), 1),
]
OTHERWISE = 3


def rule_table(spark: SparkSession, families: list[str] | None = None) -> DataFrame:
    """A row for each rule and device type: small and fixed, so it is safe to broadcast."""
    rows = [
        (rule, device, sensor, windowed, lo, hi, window, share, anomalies, rule == 7)
        for rule, family, sensor, windowed, lo, hi, window, share, anomalies in RULES
        if families is None or family in families
        for device in FAMILIES[family]
        if not (rule == 7 and device in DEFROST)
    ]
    return spark.createDataFrame(rows, "rule int, _device_type string, _sensor_type string, windowed boolean, lo double, hi double, win int, as_share boolean, keep_anomalies boolean, no_defrost boolean")


def status_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATUS.items()), "StatusCode int, Description string")
