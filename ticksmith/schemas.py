"""Column layouts of the nine telemetry tables.

Bronze holds every column as string; silver gives each its type.  The
layouts below are fixed values that must agree with the parsed-recording
format (column names as produced by the parser, types as in the typed
layer).  Type codes: s=string, i=int, l=bigint, d=double, b=boolean,
u=unsigned 64-bit (decimal(20,0)).
"""

from __future__ import annotations

from pyspark.sql import types as T

TYPE_CODES = {
    "s": T.StringType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "b": T.BooleanType(),
    "u": T.DecimalType(20, 0),
}

# SQL spelling of the same types (DuckDB and Spark SQL both accept these)
SQL_TYPES = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "d": "DOUBLE",
             "b": "BOOLEAN", "u": "DECIMAL(20,0)"}


def _player_block(prefix: str) -> list[tuple[str, str]]:
    # fixed values: per-player column block of event tables
    return [(f"{prefix}_name", "s"), (f"{prefix}_steamid", "l"), (f"{prefix}_side", "s"),
            (f"{prefix}_X", "d"), (f"{prefix}_Y", "d"), (f"{prefix}_Z", "d"),
            (f"{prefix}_health", "i"), (f"{prefix}_place", "s")]


# --- fixed values: typed columns of each table (match_id and lineage excluded) ---
COLUMNS: dict[str, list[tuple[str, str]]] = {
    "header": [
        ("map_name", "s"), ("server_name", "s"), ("client_name", "s"),
        ("demo_version_name", "s"), ("demo_version_guid", "s"), ("patch_version", "s"),
        ("game_directory", "s"), ("demo_file_stamp", "s"), ("addons", "s"),
        ("allow_clientside_entities", "b"), ("allow_clientside_particles", "b"),
        ("fullpackets_version", "l"),
    ],
    "rounds": [
        ("round_num", "i"), ("start", "i"), ("freeze_end", "i"), ("end", "i"),
        ("official_end", "i"), ("bomb_plant", "i"), ("winner", "s"), ("reason", "s"),
        ("bomb_site", "s"),
    ],
    "kills": _player_block("attacker") + _player_block("victim") + _player_block("assister") + [
        ("tick", "i"), ("round_num", "i"), ("assistedflash", "b"), ("weapon", "s"),
        ("weapon_itemid", "l"), ("weapon_fauxitemid", "u"), ("weapon_originalowner_xuid", "l"),
        ("headshot", "b"), ("hitgroup", "s"), ("distance", "d"), ("dmg_armor", "i"),
        ("dmg_health", "i"), ("penetrated", "i"), ("noscope", "b"), ("thrusmoke", "b"),
        ("attackerblind", "b"), ("attackerinair", "b"), ("noreplay", "b"), ("dominated", "b"),
        ("revenge", "b"), ("wipe", "i"), ("ct_side", "s"), ("t_side", "s"),
    ],
    "damages": _player_block("attacker") + _player_block("victim") + [
        ("tick", "i"), ("round_num", "i"), ("armor", "i"), ("health", "i"), ("dmg_armor", "i"),
        ("dmg_health", "i"), ("dmg_health_real", "i"), ("weapon", "s"), ("hitgroup", "s"),
        ("ct_side", "s"), ("t_side", "s"),
    ],
    "grenades": [
        ("entity_id", "l"), ("thrower_steamid", "l"), ("thrower", "s"), ("grenade_type", "s"),
        ("tick", "i"), ("round_num", "i"), ("X", "d"), ("Y", "d"), ("Z", "d"),
    ],
    "shots": _player_block("player") + [
        ("tick", "i"), ("round_num", "i"), ("weapon", "s"), ("ct_side", "s"), ("t_side", "s"),
        ("silenced", "b"),
    ],
    "bomb": [
        ("tick", "i"), ("round_num", "i"), ("event", "s"), ("bombsite", "s"), ("name", "s"),
        ("X", "d"), ("Y", "d"), ("Z", "d"), ("steamid", "l"),
    ],
    "ticks": [
        ("tick", "i"), ("round_num", "i"), ("health", "i"), ("steamid", "l"), ("name", "s"),
        ("side", "s"), ("place", "s"), ("X", "d"), ("Y", "d"), ("Z", "d"),
    ],
    "cvars": [("tick", "i"), ("name", "s"), ("value", "s")],
}

ALL_TABLES = ["header", "rounds", "kills", "damages", "grenades", "shots", "bomb", "ticks", "cvars"]
# event tables that get seconds-since-round-start from the round clock
CLOCKED_TABLES = ["kills", "damages", "shots", "bomb", "ticks"]
# lineage columns carried by every bronze file
LINEAGE = ["_arquivo_origem", "_camada", "_carregado_em"]
# run-dependent audit columns, never part of a compared result
AUDIT = ["_camada", "_carregado_em", "_transformado_em", "_gerado_em"]


def bronze_columns(table: str) -> list[str]:
    return [c for c, _ in COLUMNS[table]] + ["match_id"] + LINEAGE


def bronze_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in bronze_columns(table)])


def silver_schema(table: str) -> T.StructType:
    fields = [T.StructField(c, TYPE_CODES[t], True) for c, t in COLUMNS[table]]
    return T.StructType(fields)
