"""Display strings and alert payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of cards and mails, and severity -> card colour.
ANOMALY_TITLE = "Machine Sensor Anomaly Detected"
SUMMARY_TITLE = "Sensor Monitoring Summary"
CLOSING_LINE = "Please investigate the affected machine immediately."
CARD_COLOURS = {"info": "0078D7", "warning": "FFA500", "critical": "D40000"}


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals, rounded from the exact binary value (ties to even) as C does."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def percent_text(rate: Column, digits: int = 1) -> Column:
    return F.concat(fixed(rate * 100, digits), F.lit("%"))


def capitalise(name: str) -> str:
    return name[:1].upper() + name[1:].lower()


def fact(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))


def sensor_facts(sensors: Sequence[str]) -> list[Column]:
    return [fact(capitalise(s), fixed(F.col(s), 2)) for s in sensors]


def card(title: str, summary: Column, facts: Sequence[Column], severity: Column, at: Column) -> Column:
    """Message-card JSON for one alert row."""
    colour = F.lit(CARD_COLOURS["info"])
    for level, code in CARD_COLOURS.items():
        colour = F.when(severity == level, code).otherwise(colour)
    section = F.struct(
        F.lit(f"\U0001F6A8 {title}").alias("activityTitle"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss 'UTC'").alias("activitySubtitle"),
        F.array(*facts).alias("facts"),
        F.lit(True).alias("markdown"),
    )
    return F.to_json(F.struct(
        F.lit("MessageCard").alias("@type"),
        F.lit("https://schema.org/extensions").alias("@context"),
        colour.alias("themeColor"),
        summary.alias("summary"),
        F.array(section).alias("sections"),
    ))


def sensor_rows_html(sensors: Sequence[str]) -> Column:
    """One table row per sensor."""
    cells = F.array(*[
        F.struct(F.lit(capitalise(s)).alias("name"), fixed(F.col(s), 2).alias("value")) for s in sensors
    ])
    rows = F.transform(
        cells, lambda c: F.concat(F.lit("<tr><td>"), c["name"], F.lit("</td><td>"), c["value"], F.lit("</td></tr>"))
    )
    return F.array_join(rows, "")


def alert_html(machine: Column, score: Column, at: Column, sensors: Sequence[str]) -> Column:
    """Mail body for one anomaly."""
    return F.concat(
        F.lit(f'<html><body><h2 style="color:#{CARD_COLOURS["critical"]}">{ANOMALY_TITLE}</h2>'),
        F.lit("<p><strong>Machine ID:</strong> "), machine, F.lit("</p>"),
        F.lit("<p><strong>Time:</strong> "), F.date_format(at, "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit("</p>"),
        F.lit("<p><strong>Anomaly Score:</strong> "), fixed(score, 4), F.lit("</p>"),
        F.lit('<h3>Sensor Readings:</h3><table border="1" cellpadding="5"><tr><th>Sensor</th><th>Value</th></tr>'),
        sensor_rows_html(sensors),
        F.lit(f"</table><p>{CLOSING_LINE}</p></body></html>"),
    )
