"""The same relations as ``inputs.py`` and the star, as SQL common table expressions."""

from __future__ import annotations

FEATURES = ("danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
            "instrumentalness", "liveness", "valence", "tempo")

SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def normalise(x: str) -> str:
    out = f"lower({strip(f'coalesce({x}, {chr(39) * 2})')})"
    for remark in (r"\(.*?\)", r"\[.*?\]"):
        out = strip(f"regexp_replace({out}, '{remark}', '', 'g')")
    return f"regexp_replace({out}, '{SPACE}+', ' ', 'g')"


def token_sorted(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(regexp_split_to_array({x}, '{SPACE}+'), lambda t: t <> '')), ' ')"


def lcs(x: str, y: str) -> str:
    """Bit-parallel longest common subsequence of two texts of at most 60 characters."""
    full = f"((1::HUGEINT << length({x})) - 1)"
    masks = (f"list_transform(range(1, length({y}) + 1), lambda j: list_sum(list_transform(range(1, length({x}) + 1), "
             f"lambda i: CASE WHEN {x}[i] = {y}[j] THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END))::HUGEINT)")
    step = f"((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(length({x}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {full})))"


CATALOGUE = """
cat AS (
  SELECT p_partkey AS row_id, p_name AS cancion, p_brand AS artista,
         CASE WHEN p_size > 40 THEN p_type || ' año' ELSE p_type END AS album,
         CASE WHEN p_size < 50 THEN p_size * 18000.0::DOUBLE END AS duration_ms,
         CASE WHEN p_size > 1 THEN p_size / 51.0::DOUBLE END AS danceability,
         p_retailprice / 4013.0::DOUBLE AS energy, (p_partkey % 12)::DOUBLE AS key,
         p_size / -2.0::DOUBLE AS loudness, (p_partkey % 2)::DOUBLE AS mode,
         p_size / 101.0::DOUBLE AS speechiness, 1.0::DOUBLE - p_size / 53.0::DOUBLE AS acousticness,
         p_retailprice / 8011.0::DOUBLE AS instrumentalness, p_size / 77.0::DOUBLE AS liveness,
         p_retailprice / 5003.0::DOUBLE AS valence, p_size * 2.0::DOUBLE + 60.0::DOUBLE AS tempo
  FROM part)"""

SONGS = CATALOGUE + """,
songs AS (SELECT * FROM cat QUALIFY row_number() OVER (PARTITION BY cancion, artista ORDER BY row_id) = 1)"""

ARTIST = """
artist_ids AS (
  SELECT nombre, row_number() OVER (ORDER BY nombre) AS idArtista
  FROM (SELECT DISTINCT coalesce(artista, 'Desconocido') AS nombre FROM cat) WHERE nombre <> 'Desconocido'),
artist_info AS (
  SELECT 'Brand#' || s_nationkey AS nombre,
         CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal > 5000 THEN 'Group' ELSE 'Person' END AS tipo, n_name AS pais
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  QUALIFY row_number() OVER (PARTITION BY nombre ORDER BY tipo NULLS LAST, pais NULLS LAST) = 1),
artist_genre AS (
  SELECT 'Brand#' || n_nationkey AS nombre, nullif(r_name, 'AFRICA') AS genero
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_artista AS (
  SELECT -1 AS idArtista, 'Desconocido' AS nombre, 'Desconocido' AS pais, 'Desconocido' AS tipo, 'Desconocido' AS genero
  UNION ALL
  SELECT idArtista, a.nombre, coalesce(pais, 'Desconocido'), coalesce(tipo, 'Desconocido'), coalesce(genero, 'Desconocido')
  FROM artist_ids a LEFT JOIN artist_info i ON a.nombre = i.nombre LEFT JOIN artist_genre g ON a.nombre = g.nombre)"""


def ascii_only(x: str) -> str:
    return rf"regexp_replace({x}, '[^\x00-\x7F]+', '', 'g')"


ALBUM = f"""
album_ids AS (
  SELECT nombre, artista, row_number() OVER (ORDER BY nombre, artista) AS idAlbum
  FROM (SELECT DISTINCT {ascii_only("coalesce(album, 'Desconocido')")} AS nombre, artista FROM cat)),
album_info AS (
  SELECT {ascii_only('p_type')} AS nombre, p_brand AS artista,
         CASE WHEN p_size > 10 THEN 'Label ' || p_size END AS productora,
         CASE WHEN p_size = 13 THEN NULL ELSE p_size + 1950 END AS anyo
  FROM part
  QUALIFY row_number() OVER (PARTITION BY nombre, artista ORDER BY productora NULLS LAST, anyo NULLS LAST) = 1),
dim_album AS (
  SELECT -1 AS idAlbum, 'Desconocido' AS nombre, 'Desconocido' AS artista, 'Desconocido' AS productora, -1 AS anyo
  UNION ALL
  SELECT idAlbum, a.nombre, a.artista, coalesce(productora, 'Desconocido'), coalesce(anyo, -1)
  FROM album_ids a LEFT JOIN album_info i ON a.nombre = i.nombre AND a.artista = i.artista)"""

SONG = """
playlist AS (
  SELECT DISTINCT p_name AS titulo, p_brand AS artista
  FROM conversations JOIN part ON conv_id + turn = p_partkey WHERE role = 'assistant'),
song_ids AS (SELECT *, row_number() OVER (ORDER BY cancion, artista) AS idCancion FROM songs),
dim_cancion AS (
  SELECT -1 AS idCancion, 'Desconocido' AS titulo, 'Desconocido' AS album, 'Desconocido' AS artista, 0 AS playlist,
         'Desconocido' AS rangoDuracion
  UNION ALL
  SELECT idCancion, cancion, album, s.artista, CASE WHEN p.titulo IS NULL THEN 0 ELSE 1 END,
         CASE WHEN duration_ms / 60000 <= 2 THEN '0-2 min' WHEN duration_ms / 60000 <= 4 THEN '2-4 min'
              WHEN duration_ms / 60000 <= 7 THEN '4-7 min' WHEN duration_ms / 60000 <= 11 THEN '7-11 min'
              ELSE '11+ min' END
  FROM song_ids s LEFT JOIN playlist p ON s.cancion = p.titulo AND s.artista = p.artista)"""

USER = """
profiles AS (
  SELECT c_name AS nombre, lower(c_mktsegment) || '@example.org' AS email, n_name AS pais,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE 1940 + c_custkey % 75 END AS birth
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
dim_usuario AS (
  SELECT -1 AS idUsuario, 'Desconocido' AS generacion, 'Desconocido' AS pais, 'Desconocido' AS tipoUsuario,
         'Desconocido' AS nombre, 'Desconocido' AS email
  UNION ALL
  SELECT row_number() OVER (ORDER BY nombre),
         CASE WHEN birth < 1946 THEN 'Generacion Silenciosa' WHEN birth < 1965 THEN 'Baby Boomers'
              WHEN birth < 1981 THEN 'Generacion X' WHEN birth < 1997 THEN 'Millennials' ELSE 'Generacion Z' END,
         pais, 'desconocido', nombre, email
  FROM profiles)"""

EASTER = """
golden AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
epact AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM golden),
wday AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM epact),
serial AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS s FROM wday),
good_friday AS (SELECT make_date(y, s // 31, s % 31 + 1) - 2 AS fecha FROM serial)"""


def date_dim(source: str, column: str) -> str:
    return f"""
days AS (
  SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS fecha
  FROM (SELECT min({column})::DATE AS lo, max({column})::DATE AS hi FROM {source})),
years AS (SELECT DISTINCT year(fecha) AS y FROM days),{EASTER},
calendar AS (
  SELECT (strftime(fecha, '%Y%m%d'))::INTEGER AS idDate, day(fecha)::INTEGER AS dia, month(fecha)::INTEGER AS mes,
         year(fecha)::INTEGER AS anio,
         (strftime(fecha, '%m-%d') IN ('01-01', '01-06', '05-01', '08-15', '10-12', '11-01', '12-06', '12-08', '12-25')
          OR fecha IN (SELECT fecha FROM good_friday)) AS festivo,
         dayofweek(fecha) IN (0, 6) AS finde, strftime(fecha, '%Y-%m-%d') AS fechaString,
         monthname(fecha) AS mesString,
         CASE WHEN month(fecha) <= 3 THEN 'Invierno' WHEN month(fecha) <= 6 THEN 'Primavera'
              WHEN month(fecha) <= 9 THEN 'Verano' ELSE 'Otoño' END AS estacion
  FROM days),
dim_fecha AS (
  SELECT -1 AS idDate, NULL AS dia, NULL AS mes, NULL AS anio, NULL AS festivo, NULL AS finde,
         'Desconocido' AS fechaString, 'Desconocido' AS mesString, 'Desconocido' AS estacion
  UNION ALL SELECT * FROM calendar)"""


HOUR = """
bands AS (
  SELECT * FROM (VALUES (0, 'Madrugada', 0, 5), (1, 'Mañana', 6, 11), (2, 'Tarde', 12, 17), (3, 'Noche', 18, 23))
  t(idHora, franjaHoraria, inicio, fin)),
dim_hora AS (SELECT -1 AS idHora, 'Desconocido' AS franjaHoraria, NULL AS inicio, NULL AS fin UNION ALL SELECT * FROM bands)"""

PLAYS = """
plays AS (
  SELECT event_id AS play_id,
         CASE WHEN event_type = 'error' THEN 'guest' ELSE 'Customer#' || lpad(user_id::VARCHAR, 9, '0') END AS usuario,
         CASE WHEN event_type <> 'purchase' THEN ts END AS endTime,
         CASE WHEN event_type = 'signup' THEN p_name || ' live' ELSE p_name END AS trackName,
         p_brand AS artistName, round(value * 1000)::INTEGER AS msPlayed
  FROM events JOIN part ON (props->>'$.k')::BIGINT = p_partkey)"""

MANY_PLAYS = """
plays AS (
  SELECT l_orderkey * 10 + l_linenumber AS play_id, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS usuario,
         l_shipdate + to_hours((l_quantity % 24)::INTEGER) AS endTime, p_name AS trackName, p_brand AS artistName,
         round(l_extendedprice)::INTEGER AS msPlayed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

FACT = f"""
fact_raw AS (
  SELECT p.play_id, p.msPlayed, s.duration_ms::BIGINT AS msTotal, {', '.join('s.' + f for f in FEATURES)},
         k.idCancion, a.idArtista, b.idAlbum, h.idHora, u.idUsuario,
         strftime(p.endTime, '%Y%m%d')::INTEGER AS idDate
  FROM plays p
  LEFT JOIN bands h ON hour(p.endTime) BETWEEN h.inicio AND h.fin
  LEFT JOIN dim_usuario u ON p.usuario = u.nombre
  LEFT JOIN songs s ON p.trackName = s.cancion AND p.artistName = s.artista
  LEFT JOIN dim_cancion k ON p.trackName = k.titulo AND p.artistName = k.artista
  LEFT JOIN dim_artista a ON p.artistName = a.nombre
  LEFT JOIN dim_album b ON {ascii_only('s.album')} = b.nombre AND p.artistName = b.artista),
fact AS (
  SELECT play_id AS idhechos_historial, msPlayed AS msEscuchados,
         greatest(coalesce(msTotal, 0) - msPlayed, 0)::INTEGER AS msNoEscuchados, 1 AS cancionesEscuchadas,
         coalesce(msTotal, 0)::INTEGER AS msTotal,
         {', '.join(f'coalesce({f}, 0)' + ('::INTEGER' if f in ('key', 'mode') else '') + f' AS {f}' for f in FEATURES)},
         coalesce(idCancion, -1)::INTEGER AS IDCancion, coalesce(idArtista, -1)::INTEGER AS IDArtista,
         coalesce(idAlbum, -1)::INTEGER AS IDAlbum, coalesce(idHora, -1)::INTEGER AS IDHora,
         coalesce(idDate, -1)::INTEGER AS IDDate, coalesce(idUsuario, -1)::INTEGER AS IDUsuario,
         danceability IS NULL AS is_imputed
  FROM fact_raw)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def star(large: bool = False) -> str:
    source, column = ("lineitem", "l_shipdate") if large else ("events", "ts")
    return with_(SONGS, ARTIST, ALBUM, SONG, USER, date_dim(source, column), HOUR, MANY_PLAYS if large else PLAYS, FACT)


LONG_SUMS = ("msEscuchados", "msNoEscuchados", "msTotal", "cancionesEscuchadas")
DOUBLE_SUMS = ("danceability", "energy", "valence", "acousticness", "tempo", "speechiness", "instrumentalness", "liveness")

MEASURES = ", ".join(
    ["count(*) AS _COUNT_"]
    + [f"sum({c})::BIGINT AS {c.upper()}_SUM" for c in LONG_SUMS]
    + ["count(DISTINCT IDCancion) AS CANCIONES_DISTINTAS"]
    + [f"round(sum({c}), 4) AS {c.upper()}_SUM" for c in DOUBLE_SUMS]
)

VIEW = """
starview AS (
  SELECT f.*, d.anio AS ANIO, d.mes AS MES, d.dia AS DIA, d.mesString AS MESSTRING, d.estacion AS ESTACION,
         d.finde AS FINDE, d.festivo AS FESTIVO, d.fechaString AS FECHASTRING, h.franjaHoraria AS FRANJAHORARIA,
         a.nombre AS ARTISTA_NOMBRE, a.genero AS ARTISTA_GENERO, a.pais AS ARTISTA_PAIS, a.tipo AS ARTISTA_TIPO,
         b.nombre AS ALBUM_NOMBRE, b.productora AS PRODUCTORA, b.anyo AS ALBUM_ANYO,
         c.titulo AS TITULO, c.rangoDuracion AS RANGODURACION, c.playlist AS PLAYLIST,
         u.nombre AS USUARIO_NOMBRE, u.generacion AS GENERACION, u.pais AS USUARIO_PAIS, u.tipoUsuario AS TIPOUSUARIO
  FROM fact f LEFT JOIN dim_fecha d ON f.IDDate = d.idDate LEFT JOIN dim_hora h ON f.IDHora = h.idHora
  LEFT JOIN dim_artista a ON f.IDArtista = a.idArtista LEFT JOIN dim_album b ON f.IDAlbum = b.idAlbum
  LEFT JOIN dim_cancion c ON f.IDCancion = c.idCancion LEFT JOIN dim_usuario u ON f.IDUsuario = u.idUsuario)"""


def cube(large: bool = False) -> str:
    return star(large) + "," + VIEW


def grouping(sets, dims) -> str:
    """GROUP BY GROUPING SETS with the same cuboid number as the cube."""
    return "GROUP BY GROUPING SETS (" + ", ".join("(" + ", ".join(s) + ")" for s in sets) + ")"
