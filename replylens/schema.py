"""Column contracts: the raw message log, model replies and insight documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Timestamps carry no zone in the log, so they are TIMESTAMP_NTZ throughout: dates
# and hours then never depend on the session time zone.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("detected_intent", T.IntegerType()),
        T.StructField("message_input", T.StringType()),
        T.StructField("message_output", T.StringType()),
        T.StructField("sender_action", T.StringType()),
        T.StructField("final_message_sent", T.StringType()),
        T.StructField("sender_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("synced_at", T.TimestampNTZType()),
    ]
)

TEXT_COLUMNS = ["message_input", "message_output", "final_message_sent"]
TIME_COLUMNS = ["created_at", "synced_at"]

# Outcome name -> flag column.
ACTION_FLAGS = {
    "ACCEPTED": "suggestion_accepted",
    "EDITED": "suggestion_edited",
    "IGNORED": "suggestion_ignored",
    "SKIPPED": "suggestion_skipped",
}

TIME_STEP_COLUMNS = [
    "created_at",
    "id",
    "sender_action",
    "sender_id",
    "detected_intent",
    *ACTION_FLAGS.values(),
]

# The index is read as a double so that 0 and 0.0 both match position 0, while a
# quoted "0" stays null and therefore counts as missing.
REPLY_ITEM = (
    "struct<id:double,rejection_reason:string,improvement_areas:string,"
    "intent_accuracy:boolean,rejection_category:string>"
)
REPLY_LIST = f"array<{REPLY_ITEM}>"

# Field names of the insights document.
INSIGHTS_SCHEMA = (
    "struct<resumen_ejecutivo:string,"
    "hallazgos_clave:array<string>,"
    "recomendaciones_priorizadas:array<struct<recomendacion:string,impacto_esperado:string,"
    "esfuerzo_estimado:string,clusters_relacionados:array<string>>>,"
    "mejoras_especificas_por_cluster:map<string,array<string>>,"
    "sugerencias_sistema_intencion:array<string>,"
    "proximos_pasos_sugeridos:array<string>>"
)


class MissingColumnsError(ValueError):
    """A step was given a frame without the columns it reads."""


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumnsError(f"missing columns: {', '.join(absent)}")
    return df
