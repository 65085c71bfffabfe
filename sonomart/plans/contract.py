"""Column names and types of the star, with the table comments of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

# Audio features, those that get noise, and the tables with their columns.
FEATURES = (
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
)
CATALOGUE_FEATURES = FEATURES + ("duration_ms",)
NOISY_FEATURES = (
    "danceability", "energy", "valence", "acousticness", "speechiness", "liveness", "instrumentalness",
)

# table -> (comment, ((column, type, comment), ...))
STAR = {
    "dim_artista": ("Artists of the listening history.", (
        ("idArtista", "int", "Surrogate key, -1 for unknown."), ("nombre", "string", "Artist name."),
        ("pais", "string", "Country of origin."), ("tipo", "string", "Person, group, ..."),
        ("genero", "string", "Main genre."))),
    "dim_album": ("Albums of the listening history.", (
        ("idAlbum", "int", "Surrogate key, -1 for unknown."), ("nombre", "string", "Album name, ASCII only."),
        ("artista", "string", "Artist of the album."), ("productora", "string", "Record label."),
        ("anyo", "int", "Release year, -1 for unknown."))),
    "dim_cancion": ("Songs of the listening history.", (
        ("idCancion", "int", "Surrogate key, -1 for unknown."), ("titulo", "string", "Title."),
        ("album", "string", "Album name."), ("artista", "string", "Artist name."),
        ("playlist", "tinyint", "1 if some playlist holds the song."),
        ("rangoDuracion", "string", "Duration band."))),
    "dim_fecha": ("Calendar, one row per day.", (
        ("idDate", "int", "yyyyMMdd."), ("dia", "int", "Day of month."), ("mes", "int", "Month."),
        ("anio", "int", "Year."), ("festivo", "boolean", "Public holiday."), ("finde", "boolean", "Weekend."),
        ("fechaString", "string", "yyyy-MM-dd."), ("mesString", "string", "Month name."),
        ("estacion", "string", "Season."))),
    "dim_hora": ("Bands of the day.", (
        ("idHora", "int", "0 to 3, -1 for unknown."), ("franjaHoraria", "string", "Band name."),
        ("inicio", "int", "First hour."), ("final", "int", "Last hour."))),
    "dim_usuario": ("Listeners.", (
        ("idUsuario", "int", "Surrogate key, -1 for unknown."), ("generacion", "string", "Generation."),
        ("pais", "string", "Country of the account."), ("tipoUsuario", "string", "Account type."),
        ("nombre", "string", "Folder name of the user."), ("email", "string", "E-mail."))),
    "fact_historial": ("One row per play.", (
        ("idhechos_historial", "bigint", "Row id."), ("msEscuchados", "int", "Milliseconds played."),
        ("msNoEscuchados", "int", "Milliseconds not played."), ("cancionesEscuchadas", "int", "Always 1."),
        ("msTotal", "int", "Duration in milliseconds."),
        *((f, "int" if f in ("key", "mode") else "double", "Audio feature.") for f in FEATURES),
        *((k, "int", "Foreign key.") for k in
          ("IDCancion", "IDArtista", "IDAlbum", "IDHora", "IDDate", "IDUsuario")))),
}

# fact key -> (dimension, its key)
FOREIGN_KEYS = {
    "IDCancion": ("dim_cancion", "idCancion"),
    "IDArtista": ("dim_artista", "idArtista"),
    "IDAlbum": ("dim_album", "idAlbum"),
    "IDHora": ("dim_hora", "idHora"),
    "IDDate": ("dim_fecha", "idDate"),
    "IDUsuario": ("dim_usuario", "idUsuario"),
}


def table_schema(table: str) -> StructType:
    comment = "comment"
    return StructType([
        StructField(name, _parse_datatype_string(kind), True, {comment: text}) for name, kind, text in STAR[table][1]
    ])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Contract columns in contract order and type."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t, _ in STAR[table][1]])


def create_table_sql(table: str, location: str | None = None, partitioned_by: str | None = None) -> str:
    comment, columns = STAR[table]
    body = ",\n  ".join(f"`{n}` {t.upper()} COMMENT '{c}'" for n, t, c in columns)
    if partitioned_by:
        body += f",\n  `{partitioned_by}` INT"
    sql = f"CREATE TABLE IF NOT EXISTS {table} (\n  {body}\n) USING PARQUET"
    if partitioned_by:
        sql += f" PARTITIONED BY (`{partitioned_by}`)"
    if location:
        sql += f" LOCATION '{location}'"
    return sql + f" COMMENT '{comment}'"
