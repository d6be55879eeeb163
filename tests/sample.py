"""Golden sample: eight cargo rows with planted faults, and one rule per kind of check
over them (FIXTURES.md sections 3-4)."""

from __future__ import annotations

TABLE = "embarques"
SCHEMA = "puerto"

# a pattern with a doubled backslash, as rule tables often hold it (it asks for a literal
# backslash, so nothing matches), and the meant one
CODE_DOUBLED = r"^[A-Z]{2}\\.[0-9]{3}$"
CODE_FIXED = r"^[A-Z]{2}\.[0-9]{3}$"

CARGO_DDL = ("guia string, destino string, situacion string, peso_kg double, contenedor string, "
             "codigo string, bultos long, nota string")

CARGO_ROWS = [
    ("E-11", "Vigo", "cargado", 1200.0, "CONT-000017", "VG.104", 12, "fragil"),
    ("E-12", "Oporto", "en ruta", -3.5, "CONT-000018", "OP.220", 40, "\t"),
    ("E-13", None, "cargado", 87.25, "CONT-19", "VG.105", 1, "frio"),
    ("E-14", "Cork", "perdido", 0.0, "CONT-000020", "ck.007", 0, "   "),
    ("E-15", "Vigo", None, -1.0, None, "VG.106", 41, None),
    ("E-16", "Brest", "entregado", 640.0, "CONT-000022", "BR.31", None, "seco"),
    ("E-17", "Oporto", "en ruta", None, "CONT-0000230", "OP.221", 7, "seco"),
    ("E-18", "Cork", "cargado", 15.0, "CONT-000024", "CK.008", 39, "frio"),
]


def rule(column, code, params="", threshold=100.0, *, table=TABLE, schema=SCHEMA, filters="",
         active=True):
    return {
        "id_calidad_tabla": table, "coleccion": schema, "nombre_columna": column,
        "id_calidad_regla": code, "parametros": params, "filtros": filters, "estado": active,
        "descripcion": f"{code} on {column}", "umbral": threshold, "macrodominio": "CARGA",
        "dominio": "muelle", "usuario_cambio": "grua",
        "fecha_cambio": "2025-11-03 06:00:00",
    }


# --- Fixed values: columns of the rule table
RULE_DDL = ("id_calidad_tabla string, coleccion string, nombre_columna string, "
            "id_calidad_regla string, parametros string, filtros string, estado boolean, "
            "descripcion string, umbral double, macrodominio string, dominio string, "
            "usuario_cambio string, fecha_cambio string")
RULE_FIELDS = [f.split()[0] for f in RULE_DDL.split(", ")]

SAMPLE_RULES = [
    rule("destino", "COM_NULOS", threshold=99.0),
    rule("guia", "COM_DUPLICADOS", threshold=100.0),
    rule("situacion", "VAL_PERMITIDOS", "cargado,en ruta,entregado", 92.5),
    rule("peso_kg", "VAL_POSITIVOS", threshold=70.5),
    rule("contenedor", "CONF_LONG_EXACTA", "11", 60.0),
    rule("codigo", "CONF_REGEX", CODE_DOUBLED, 80.0),
    rule("bultos", "VAL_RANGO_VALORES", "1,40", 96.0),
    rule("nota", "COM_OBLIGATORIO", threshold=75.0),
]


def rules_df(spark, rules):
    return spark.createDataFrame([tuple(r.get(f) for f in RULE_FIELDS) for r in rules], RULE_DDL)


def cargo_df(spark):
    return spark.createDataFrame(CARGO_ROWS, CARGO_DDL)
