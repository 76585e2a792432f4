"""The registered queries once more, as plain SQL for another engine.

Written independently of the Spark code: composite networks are taken straight from the line
items, goals come from a formula instead of an unpivot, events from their ingredients instead
of JSON.  ``FRAGMENTS`` are named subqueries; :func:`_with` puts the ones a statement uses,
and the ones those use, in front of it.
"""

from __future__ import annotations

import re

# Role of the goal calendar in the test tables.
YEAR, FINAL = 2000, 2002

FRAGMENTS = {
    "grp": """SELECT * FROM (VALUES
        (2, 0), (3, 0), (4, 0), (2, 5), (3, 5), (2, 2), (3, 3), (4, 4)) AS g(membro, rede)""",
    "grp_label": """SELECT * FROM (VALUES
        (0, 'Total (Federal, Estadual, Municipal e Privada)'),
        (5, 'Pública (Estadual e Municipal)'),
        (2, 'Estadual'), (3, 'Municipal'), (4, 'Privada')) AS g(rede, rede_descricao)""",
    "rede_dic": """SELECT * FROM (VALUES
        (0, 'Total'), (2, 'Estadual'), (3, 'Municipal'), (5, 'Pública'),
        (4, 'Nao informado')) AS d(rede, rede_descricao)""",
    "serie_dic": """SELECT * FROM (VALUES (2, '2º ano'), (5, '5º ano'))
        AS d(serie, serie_descricao)""",
    "raw_pupil": """SELECT
            CAST(year(l_shipdate) AS INTEGER) AS ano,
            CAST(l_suppkey AS VARCHAR) AS id_municipio,
            CAST(l_partkey AS VARCHAR) AS id_escola,
            concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS id_aluno,
            CAST(l_linenumber AS VARCHAR) AS caderno,
            CASE WHEN l_linestatus = 'F' THEN 2 ELSE 5 END AS serie,
            CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 4 END AS rede,
            CASE WHEN l_tax >= 0.01 THEN 1 ELSE 0 END AS presenca,
            CASE WHEN l_tax >= 0.04 THEN 1 ELSE 0 END AS preenchimento_caderno,
            CASE WHEN l_linenumber = 7 THEN NULL
                 WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS alfabetizado,
            l_extendedprice AS proficiencia,
            CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_quantity END AS peso_aluno
        FROM lineitem""",
    "locality": """SELECT CAST(s_suppkey AS VARCHAR) AS id_municipio,
            s_name AS nome_municipio, n_name AS sigla_uf
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_suppkey % 20 <> 19""",
    "pupil": """SELECT p.*, l.nome_municipio, l.sigla_uf, s.serie_descricao,
            r.rede_descricao, p.ano AS ano_referencia
        FROM (SELECT DISTINCT * FROM raw_pupil) p
        LEFT JOIN locality l USING (id_municipio)
        JOIN serie_dic s USING (serie)
        JOIN rede_dic r USING (rede)""",
    "published_line": """SELECT p.*, g.rede AS grupo, s.s_nationkey,
            CAST(round(p.proficiencia * 100) AS BIGINT) AS centavos,
            least(CAST(round(l_discount * 100) AS INTEGER), 8) AS nivel
        FROM (SELECT l_suppkey, l_discount, CAST(year(l_shipdate) AS INTEGER) AS ano,
                CASE WHEN l_linestatus = 'F' THEN 2 ELSE 5 END AS serie,
                CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 4 END AS rede,
                CASE WHEN l_linenumber = 7 THEN NULL
                     WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS alfabetizado,
                l_extendedprice AS proficiencia,
                CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_quantity END AS peso_aluno
            FROM lineitem) p
        JOIN grp g ON g.membro = p.rede
        JOIN supplier s ON s.s_suppkey = p.l_suppkey""",
    "silver_m": """SELECT m.*, l.nome_municipio, l.sigla_uf, r.rede_descricao,
            s.serie_descricao, m.ano AS ano_referencia
        FROM (SELECT CAST(l_suppkey AS VARCHAR) AS id_municipio, ano, serie,
                grupo AS rede, {rate} AS taxa_alfabetizacao, {score} AS media_portugues,
                {levels}
            FROM published_line GROUP BY l_suppkey, ano, serie, grupo) m
        LEFT JOIN locality l USING (id_municipio)
        JOIN rede_dic r USING (rede) JOIN serie_dic s USING (serie)""",
    "silver_s": """SELECT m.*, r.rede_descricao, s.serie_descricao, m.ano AS ano_referencia
        FROM (SELECT n_name AS sigla_uf, ano, serie,
                grupo AS rede, {rate} AS taxa_alfabetizacao, {score} AS media_portugues,
                {levels}
            FROM published_line JOIN nation ON n_nationkey = s_nationkey
            GROUP BY n_name, ano, serie, grupo) m
        JOIN rede_dic r USING (rede) JOIN serie_dic s USING (serie)""",
    "calendar": """SELECT p.p, y.y FROM (VALUES (1998), (1999), (2000), (2001)) AS p(p)
        JOIN (VALUES (1996), (1997), (1998), (1999), (2000), (2001), (2002)) AS y(y)
        ON y.y >= p.p""",
    "goal_base": """SELECT 'municipio' AS escopo, CAST(s_suppkey AS VARCHAR) AS chave,
            CASE WHEN s_suppkey % 25 = 24 THEN 'Outra' ELSE 'Municipal' END AS rede_descricao,
            s_suppkey % 15 AS base FROM supplier
        UNION ALL
        SELECT 'uf', n_name, 'Pública', n_nationkey % 15 FROM nation
        UNION ALL
        SELECT 'brasil', 'BR', 'Pública', max(n_nationkey) % 15 FROM nation""",
    "goal": """SELECT escopo, chave,
            CASE rede_descricao WHEN 'Municipal' THEN 3 WHEN 'Pública' THEN 5 END AS rede,
            rede_descricao, p AS ano_publicacao, y AS ano_meta,
            CAST(40 + base + 3 * (y - 1995) + (p - 1998) * 0.5 AS DOUBLE)
                AS meta_alfabetizacao
        FROM goal_base JOIN calendar ON true""",
    "volume_m": """SELECT id_municipio, ano, serie, g.rede, count(alfabetizado) AS qtd_alunos
        FROM pupil p JOIN grp g ON g.membro = p.rede
        GROUP BY id_municipio, ano, serie, g.rede""",
    "volume_s": """SELECT sigla_uf, ano, serie, g.rede, count(alfabetizado) AS qtd_alunos
        FROM pupil p JOIN grp g ON g.membro = p.rede
        GROUP BY sigla_uf, ano, serie, g.rede""",
    "country": """SELECT c.*, l.rede_descricao, c.ano AS ano_referencia,
            'calculado_microdado' AS origem_indicador, 'brasil' AS nivel_geografico,
            g.meta_alfabetizacao AS meta_alfabetizacao_do_ano,
            c.taxa_alfabetizacao - g.meta_alfabetizacao AS gap_meta_do_ano_pp
        FROM (SELECT ano, serie, serie_descricao, g.rede,
                {rate} AS taxa_alfabetizacao, count(alfabetizado) AS qtd_alunos
            FROM pupil p JOIN grp g ON g.membro = p.rede
            GROUP BY ano, serie, serie_descricao, g.rede) c
        JOIN grp_label l USING (rede)
        LEFT JOIN goal g ON g.escopo = 'brasil' AND g.rede = c.rede
            AND g.ano_publicacao = c.ano AND g.ano_meta = c.ano""",
    "state": """SELECT s.sigla_uf, s.ano, s.ano_referencia, s.serie, s.serie_descricao,
            s.rede, s.rede_descricao, s.taxa_alfabetizacao, s.media_portugues,
            'inep_publicado' AS origem_indicador, v.qtd_alunos,
            g.meta_alfabetizacao AS meta_alfabetizacao_do_ano,
            s.taxa_alfabetizacao - g.meta_alfabetizacao AS gap_meta_do_ano_pp,
            c.taxa_alfabetizacao AS taxa_alfabetizacao_brasil,
            s.taxa_alfabetizacao - c.taxa_alfabetizacao AS diferenca_pp_vs_brasil,
            'uf' AS nivel_geografico
        FROM silver_s s
        LEFT JOIN volume_s v ON v.sigla_uf = s.sigla_uf AND v.ano = s.ano
            AND v.serie = s.serie AND v.rede = s.rede
        LEFT JOIN goal g ON g.escopo = 'uf' AND g.chave = s.sigla_uf AND g.rede = s.rede
            AND g.ano_publicacao = s.ano AND g.ano_meta = s.ano
        LEFT JOIN country c ON c.ano = s.ano AND c.serie = s.serie AND c.rede = s.rede""",
    "municipality": """SELECT m.id_municipio, m.nome_municipio, m.sigla_uf, m.ano,
            m.ano_referencia, m.serie, m.serie_descricao, m.rede, m.rede_descricao,
            m.taxa_alfabetizacao, m.media_portugues,
            'inep_publicado' AS origem_indicador, v.qtd_alunos,
            g.meta_alfabetizacao AS meta_alfabetizacao_do_ano,
            m.taxa_alfabetizacao - g.meta_alfabetizacao AS gap_meta_do_ano_pp,
            s.taxa_alfabetizacao AS taxa_alfabetizacao_uf,
            m.taxa_alfabetizacao - s.taxa_alfabetizacao AS diferenca_pp_vs_uf,
            c.taxa_alfabetizacao AS taxa_alfabetizacao_brasil,
            m.taxa_alfabetizacao - c.taxa_alfabetizacao AS diferenca_pp_vs_brasil,
            'municipio' AS nivel_geografico
        FROM silver_m m
        LEFT JOIN volume_m v ON v.id_municipio = m.id_municipio AND v.ano = m.ano
            AND v.serie = m.serie AND v.rede = m.rede
        LEFT JOIN goal g ON g.escopo = 'municipio' AND g.chave = m.id_municipio
            AND g.rede = m.rede AND g.ano_publicacao = m.ano AND g.ano_meta = m.ano
        LEFT JOIN silver_s s ON s.sigla_uf = m.sigla_uf AND s.ano = m.ano
            AND s.serie = m.serie AND s.rede = m.rede
        LEFT JOIN country c ON c.ano = m.ano AND c.serie = m.serie AND c.rede = m.rede""",
    "goal_event": """SELECT event_id, user_id % 9 AS forma,
            CAST(1998 + event_id % 4 AS INTEGER) AS ano, value,
            CASE event_type WHEN 'view' THEN 'Municipal' WHEN 'error' THEN 'Outra'
                ELSE 'Pública' END AS rede
        FROM events""",
    "goal_streamed": """SELECT 'brasil' AS escopo, 'BR' AS chave,
            CASE e.rede WHEN 'Municipal' THEN 3 WHEN 'Pública' THEN 5 END AS rede,
            e.rede AS rede_descricao, e.ano AS ano_publicacao, CAST(y AS INTEGER) AS ano_meta,
            e.value + y - 1995 AS meta_alfabetizacao
        FROM goal_event e JOIN range(1996, 2003) AS r(y) ON y > e.ano
        WHERE e.event_id IN (SELECT max(event_id) FROM goal_event WHERE forma <= 5
            GROUP BY ano, rede)""",
    "goal_now": """SELECT * FROM goal_streamed
        UNION ALL SELECT g.* FROM goal g ANTI JOIN goal_streamed
            USING (escopo, chave, rede_descricao, ano_publicacao, ano_meta)""",
}

# Pieces that occur in several fragments.
PIECES = {
    "rate": """coalesce(
        100.0::DOUBLE * sum(alfabetizado * peso_aluno)
            / nullif(sum(CASE WHEN alfabetizado IS NOT NULL THEN peso_aluno END), 0),
        100.0::DOUBLE * CAST(sum(alfabetizado) AS DOUBLE) / nullif(count(alfabetizado), 0))""",
    "score": "CAST(sum(centavos) AS BIGINT) / count(*) / 100.0::DOUBLE",
    "levels": ", ".join(
        f"100.0::DOUBLE * count(*) FILTER (WHERE nivel = {n}) / count(*)"
        f" AS proporcao_aluno_nivel_{n}"
        for n in range(9)
    ),
}


def _fill(sql: str) -> str:
    for name, piece in PIECES.items():
        sql = sql.replace("{" + name + "}", piece)
    return sql


def _with(sql: str) -> str:
    """Prefix a statement with the fragments it needs, in the order they are defined."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in FRAGMENTS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return _fill(sql)
    ctes = ",\n".join(f"{n} AS ({_fill(b)})" for n, b in FRAGMENTS.items() if n in needed)
    return f"WITH {ctes}\n{_fill(sql)}"


def _comparison(source: str, level: str, ids: str, key: str | None) -> str:
    """Results with the goals in force; one statement covers both scopes."""
    place = f"g.escopo = '{level}' AND g.chave = r.{key} OR " if key else ""
    return f"""SELECT '{level}' AS nivel_geografico, {ids}r.ano AS ano_observacao,
            r.serie, r.serie_descricao, r.rede, r.rede_descricao, r.taxa_alfabetizacao,
            r.qtd_alunos, r.origem_indicador, g.escopo AS escopo_meta, g.ano_meta,
            g.meta_alfabetizacao,
            r.taxa_alfabetizacao - g.meta_alfabetizacao AS gap_pp,
            100.0::DOUBLE * r.taxa_alfabetizacao / nullif(g.meta_alfabetizacao, 0)
                AS percentual_da_meta,
            r.taxa_alfabetizacao >= g.meta_alfabetizacao AS atingiu_meta,
            g.ano_meta <= r.ano AS meta_ja_vencida, r.ano
        FROM {source} r JOIN goal g
            ON g.rede = r.rede AND g.ano_publicacao = r.ano
            AND ({place}g.escopo = 'brasil' AND g.chave = 'BR')
        WHERE r.taxa_alfabetizacao IS NOT NULL"""


COMPARISON_M = _comparison(
    "municipality", "municipio", "r.id_municipio, r.nome_municipio, r.sigla_uf, ",
    "id_municipio",
)
COMPARISON_S = _comparison("state", "uf", "r.sigla_uf, ", "sigla_uf")
COMPARISON_C = _comparison("country", "brasil", "", None)

FRAGMENTS["comparison_m"] = COMPARISON_M
FRAGMENTS["comparison_s"] = COMPARISON_S


def _changes(series: str) -> str:
    """Change columns over one series; frames are spelled out."""
    w = f"(PARTITION BY {series} ORDER BY ano_referencia)"
    return f"""lag(ano_referencia) OVER {w} AS ano_anterior,
        lag(taxa_alfabetizacao) OVER {w} AS taxa_ano_anterior,
        first_value(taxa_alfabetizacao IGNORE NULLS) OVER (PARTITION BY {series}
            ORDER BY ano_referencia ROWS BETWEEN UNBOUNDED PRECEDING
            AND UNBOUNDED FOLLOWING) AS taxa_primeiro_ano"""


DIFFERENCES = """taxa_alfabetizacao - taxa_ano_anterior AS variacao_pp,
    CASE WHEN taxa_ano_anterior > 0 THEN 100.0::DOUBLE
        * (taxa_alfabetizacao - taxa_ano_anterior) / taxa_ano_anterior END
        AS variacao_percentual"""
ACCUMULATED = "taxa_alfabetizacao - taxa_primeiro_ano AS variacao_acumulada_pp"


def _evolution(source: str, level: str, key: str | None) -> str:
    series = f"{key}, rede, serie" if key else "rede, serie"
    place = f"AND g.chave = e.{key}" if key else ""
    return f"""SELECT e.*, {DIFFERENCES}, {ACCUMULATED},
            g.meta_alfabetizacao AS meta_alfabetizacao_final,
            g.meta_alfabetizacao - e.taxa_alfabetizacao AS gap_para_meta_final_pp
        FROM (SELECT *, {_changes(series)} FROM {source}) e
        LEFT JOIN goal g ON g.escopo = '{level}' AND g.ano_meta = {FINAL}
            AND g.rede = e.rede AND g.ano_publicacao = e.ano_referencia {place}"""


PARTS = """sum(alfabetizado * peso_aluno) AS peso_alfabetizado,
    sum(CASE WHEN alfabetizado IS NOT NULL THEN peso_aluno END) AS peso_conhecido,
    CAST(sum(alfabetizado) AS DOUBLE) AS alfabetizados,
    count(alfabetizado) AS qtd_alunos, count(*) AS registros"""


def _rolled_up(keys: str) -> str:
    return f"""SELECT r.*, rede_descricao FROM (
            SELECT {keys}, g.rede, {{rate}} AS taxa_alfabetizacao_calculada,
                count(alfabetizado) AS qtd_alunos
            FROM pupil p JOIN grp g ON g.membro = p.rede GROUP BY {keys}, g.rede) r
        JOIN grp_label USING (rede)"""


# Spark's hash of an ASCII text: Murmur3 with seed 42, whole words of four bytes and then single
# bytes, all in whole numbers modulo 2^32.
W32 = "& 4294967295"


def _turned(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) | (({x}) >> {32 - bits})) {W32})"


def _murmur(text: str) -> str:
    mixed = f"(x.v * 3432918353 {W32})"
    mixed = f"({_turned(mixed, 15)} * 461845907 {W32})"
    step = f"(({_turned(f'xor(x.h, {mixed})', 13)} * 5 + 3864292196) {W32})"
    byte = f"ascii(substr({text}, CAST({{}} AS INTEGER), 1))::BIGINT"
    word = " + ".join(
        f"{byte.format(f'4 * i + {n + 1}')} * {256 ** n}" for n in range(4)
    )
    parts = f"""list_concat([42::BIGINT], list_concat(
        list_transform(range(0, length({text}) // 4), lambda i: {word}),
        list_transform(range(length({text}) // 4 * 4, length({text})), lambda i: {byte.format('i + 1')})))"""
    step = step.replace("x.h", "h").replace("x.v", "v")
    hashed = f"list_reduce({parts}, lambda h, v: {step})"
    for bits, factor in ((16, 2246822507), (13, 3266489909), (16, 1)):
        first = f"xor({hashed}, length({text}))" if bits == 16 and factor != 1 else hashed
        hashed = f"list_transform([{first}], lambda z: ((xor(z, z >> {bits})::HUGEINT * {factor}) {W32})::BIGINT)[1]"
    signed = f"list_transform([{hashed}], lambda z: CASE WHEN z > 2147483647 THEN z - 4294967296 ELSE z END)[1]"
    return f"CAST((({signed}) % 100 + 100) % 100 AS INTEGER)"


BUCKET = "CAST(concat('0x', substr(md5(id_aluno), 1, 8)) AS BIGINT) % 100"
SPLIT = f"""CASE WHEN {BUCKET} < 70 THEN 'treino' WHEN {BUCKET} < 85 THEN 'validacao'
    ELSE 'teste' END"""
MURMUR_SPLIT = "CASE WHEN faixa < 70 THEN 'treino' WHEN faixa < 85 THEN 'validacao' ELSE 'teste' END"

PUPIL_TEXTS = """CASE presenca WHEN 1 THEN 'Presente' ELSE 'Ausente' END AS presenca_descricao,
    CASE preenchimento_caderno WHEN 1 THEN 'Preenchido' ELSE 'Nao informado' END
        AS preenchimento_caderno_descricao,
    CASE alfabetizado WHEN 1 THEN 'Alfabetizado' WHEN 0 THEN 'Nao alfabetizado'
        ELSE 'Nao informado' END AS alfabetizado_descricao"""

FEATURES = f"""SELECT id_aluno, id_escola, p.id_municipio, p.nome_municipio, p.sigla_uf,
        p.ano_referencia, p.serie, p.rede, p.rede_descricao, caderno, presenca,
        preenchimento_caderno, proficiencia, peso_aluno,
        m.taxa_alfabetizacao AS taxa_alfabetizacao_municipio_ano_anterior,
        m.media_portugues AS media_portugues_municipio_ano_anterior,
        {SPLIT} AS dataset_split, alfabetizado, p.ano_referencia AS ano
    FROM pupil p LEFT JOIN silver_m m ON m.id_municipio = p.id_municipio
        AND m.ano = p.ano - 1 AND m.rede = p.rede AND m.serie = p.serie
    WHERE alfabetizado IS NOT NULL"""

RATES = "ano_referencia, serie, rede, taxa_alfabetizacao"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

Q1 = f"""SELECT ano, sigla_uf, nome_municipio, rede_descricao, taxa_alfabetizacao,
        meta_alfabetizacao, gap_pp, atingiu_meta, ano_meta
    FROM comparison_m WHERE ano = {YEAR} AND ano_meta = {YEAR}
        AND rede_descricao = 'Municipal'"""

STATEMENTS = {
    # sources and sinks
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_projected": "SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem",
    "scan_partition_pruned": f"""SELECT ano, id_municipio, id_aluno, peso_aluno
        FROM raw_pupil WHERE ano = {YEAR}""",
    "snapshot_tables": """SELECT 'alunos' AS conjunto, count(*) AS registros FROM lineitem
        UNION ALL SELECT 'municipio', count(*) FROM silver_m
        UNION ALL SELECT 'uf', count(*) FROM silver_s
        UNION ALL SELECT 'dicionario', 33
        UNION ALL SELECT 'meta_alfabetizacao_brasil', 4
        UNION ALL SELECT 'meta_alfabetizacao_municipio', 4 * count(*) FROM supplier
        UNION ALL SELECT 'meta_alfabetizacao_uf', 4 * count(*) FROM nation""",
    "json_flatten": """SELECT CAST(s_suppkey AS VARCHAR) AS id_municipio,
            s_name AS nome_municipio, n_name AS sigla_uf
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "layer_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS conjunto, count(*) AS registros FROM {t}" for t in TABLES
    ),
    "list_objects": " UNION ALL ".join(
        f"SELECT '{t}' AS conjunto, count(*) > 0 AS tem_dados FROM {t}" for t in TABLES
    ),
    "describe_columns": """SELECT ordinal_position - 1 AS posicao, column_name AS coluna,
            CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS tipo
        FROM information_schema.columns WHERE table_name = 'lineitem'""",
    "head_sample": """SELECT least(count(*), 5000) AS registros,
        CAST(0 AS BIGINT) AS fora_da_tabela FROM lineitem""",
    "write_scope": """SELECT * REPLACE (meta_alfabetizacao
            + CASE escopo WHEN 'uf' THEN 0.5 ELSE 0 END::DOUBLE AS meta_alfabetizacao),
            escopo <> 'uf' AS mantido FROM goal""",
    "processing_stamp": """SELECT count(*) AS registros, CAST(1 AS BIGINT) AS carimbos,
        true AS depois_do_inicio, true AS antes_do_fim FROM silver_s""",
    "write_partitioned": """SELECT id_municipio, id_aluno, serie, rede, peso_aluno, ano,
        ano AS ano_referencia FROM raw_pupil""",
    "write_single_file": """SELECT ano, CAST(1 AS BIGINT) AS arquivos,
        count(*) AS registros FROM silver_s GROUP BY ano""",
    "register_tables": "SELECT * FROM country",
    # projections and filters
    "normalize_ids": """SELECT id_municipio, sigla_uf FROM locality
        UNION ALL SELECT id_municipio, sigla_uf FROM locality WHERE id_municipio = '1'""",
    "typed_cast": """SELECT l_orderkey, l_linenumber,
            CAST(trunc(l_quantity) AS INTEGER) AS decimal_int,
            l_linenumber AS com_brancos_int,
            CAST(trunc(l_discount) AS INTEGER) AS fracao_int,
            CAST(NULL AS INTEGER) AS texto_int,
            l_quantity AS decimal_double,
            CAST(l_linenumber AS DOUBLE) AS com_brancos_double,
            l_discount AS fracao_double,
            CAST(NULL AS DOUBLE) AS texto_double
        FROM lineitem""",
    "code_lookup": """SELECT id_aluno, concat(' ', rede) AS rede,
            CAST(serie AS VARCHAR) AS serie, CAST(presenca AS VARCHAR) AS presenca,
            rede_descricao, serie_descricao,
            CASE presenca WHEN 1 THEN 'Presente' ELSE 'Ausente' END AS presenca_descricao
        FROM raw_pupil JOIN rede_dic USING (rede) JOIN serie_dic USING (serie)""",
    "text_to_code": """SELECT CASE WHEN s_suppkey % 25 = 24 THEN 'Outra'
                ELSE ' Municipal ' END AS rede,
            CASE WHEN s_suppkey % 25 = 24 THEN NULL ELSE 3 END AS codigo,
            4 * count(*) AS registros
        FROM supplier GROUP BY 1, 2""",
    "filter_not_null": """SELECT id_aluno, alfabetizado FROM raw_pupil
        WHERE alfabetizado IS NOT NULL""",
    "filter_point": """SELECT sigla_uf, ano, serie, rede, rede_descricao, taxa_alfabetizacao
        FROM silver_s WHERE sigla_uf = 'NATION_7'""",
    "split_portable": f"""SELECT id_aluno, CAST({BUCKET} AS INTEGER) AS faixa,
        {SPLIT} AS dataset_split FROM raw_pupil""",
    "split_murmur": f"""SELECT id_aluno, faixa, {MURMUR_SPLIT} AS dataset_split
        FROM (SELECT id_aluno, {_murmur('id_aluno')} AS faixa FROM raw_pupil)""",
    # goals
    "goal_unpivot": "SELECT * FROM goal WHERE escopo = 'municipio'",
    "goal_long_union": "SELECT * FROM goal",
    "goal_of_year": """SELECT id_municipio, ano_referencia, serie, rede, taxa_alfabetizacao,
        meta_alfabetizacao_do_ano, gap_meta_do_ano_pp FROM municipality""",
    "goal_of_year_total": f"""SELECT {RATES}, meta_alfabetizacao_do_ano, gap_meta_do_ano_pp
        FROM country""",
    "goal_vs_result": """SELECT * REPLACE (CAST(NULL AS BIGINT) AS qtd_alunos,
        'publicado' AS origem_indicador) FROM comparison_m""",
    "final_goal_gap": f"""SELECT s.sigla_uf, ano_referencia, serie, s.rede,
            taxa_alfabetizacao, g.meta_alfabetizacao AS meta_alfabetizacao_final,
            g.meta_alfabetizacao - taxa_alfabetizacao AS gap_para_meta_final_pp
        FROM silver_s s LEFT JOIN goal g ON g.escopo = 'uf' AND g.chave = s.sigla_uf
            AND g.rede = s.rede AND g.ano_publicacao = s.ano AND g.ano_meta = {FINAL}""",
    # joins
    "dim_enrich": """SELECT id_aluno, id_municipio, nome_municipio, sigla_uf
        FROM raw_pupil LEFT JOIN (SELECT id_municipio, nome_municipio,
            concat(' ', lower(sigla_uf), ' ') AS sigla_uf FROM locality) USING (id_municipio)""",
    "attach_volume": f"""SELECT m.id_municipio, {RATES.replace('serie, rede',
            'm.serie, m.rede')}, qtd_alunos
        FROM silver_m m LEFT JOIN volume_m v ON v.id_municipio = m.id_municipio
            AND v.ano = m.ano AND v.serie = m.serie AND v.rede = m.rede""",
    "compare_to_parent": f"""SELECT id_municipio, sigla_uf, {RATES}, taxa_alfabetizacao_uf,
        diferenca_pp_vs_uf FROM municipality""",
    "compare_to_total": f"""SELECT sigla_uf, {RATES}, taxa_alfabetizacao_brasil,
        diferenca_pp_vs_brasil FROM state""",
    "prior_year_context": """SELECT id_aluno, p.id_municipio, p.ano AS ano_referencia,
            p.rede, p.serie, m.taxa_alfabetizacao AS taxa_alfabetizacao_municipio_ano_anterior,
            m.media_portugues AS media_portugues_municipio_ano_anterior
        FROM raw_pupil p LEFT JOIN silver_m m ON m.id_municipio = p.id_municipio
            AND m.ano = p.ano - 1 AND m.rede = p.rede AND m.serie = p.serie""",
    # aggregations
    "additive_parts": f"""SELECT sigla_uf, id_municipio, ano_referencia, serie,
            serie_descricao, rede, {PARTS}
        FROM pupil GROUP BY 1, 2, 3, 4, 5, 6""",
    "overlapping_rollup": _rolled_up("id_municipio, ano_referencia, serie"),
    "rollup_state": _rolled_up("sigla_uf, ano_referencia, serie"),
    "rollup_total": _rolled_up("ano_referencia, serie, serie_descricao"),
    "weighted_rate": """SELECT r.*, rede_descricao FROM (
            SELECT id_municipio, g.rede, {rate} AS taxa_alfabetizacao_calculada,
                count(alfabetizado) AS qtd_alunos
            FROM pupil p JOIN grp g ON g.membro = p.rede
            GROUP BY id_municipio, g.rede) r
        JOIN grp_label USING (rede)""",
    "count_by_key": """SELECT sigla_uf, ano, count(*) AS registros FROM pupil
        GROUP BY sigla_uf, ano""",
    "count_distinct": """SELECT count(DISTINCT id_aluno) AS distintos_id_aluno,
        count(DISTINCT id_municipio) AS distintos_id_municipio,
        count(DISTINCT id_escola) AS distintos_id_escola FROM pupil""",
    "percentiles": """SELECT sigla_uf, serie,
            quantile_disc(taxa_alfabetizacao, 0.1) AS p10,
            quantile_disc(taxa_alfabetizacao, 0.5) AS p50,
            quantile_disc(taxa_alfabetizacao, 0.9) AS p90
        FROM silver_m GROUP BY sigla_uf, serie""",
    "label_share": f"""SELECT dataset_split, count(*) AS registros,
            count(*) / sum(count(*)) OVER () AS fracao
        FROM (SELECT {SPLIT} AS dataset_split FROM raw_pupil) GROUP BY dataset_split""",
    # windows
    "yoy_change": f"""SELECT id_municipio, {RATES}, ano_anterior, taxa_ano_anterior,
            {DIFFERENCES}
        FROM (SELECT *, {_changes('id_municipio, rede, serie')} FROM silver_m)""",
    "yoy_change_total": f"""SELECT {RATES}, ano_anterior, taxa_ano_anterior,
            taxa_primeiro_ano, {DIFFERENCES}, {ACCUMULATED}
        FROM (SELECT *, {_changes('rede, serie')} FROM country)""",
    "cumulative_change": f"""SELECT sigla_uf, ano_referencia, serie, rede,
            taxa_primeiro_ano, {ACCUMULATED}
        FROM (SELECT *, {_changes('sigla_uf, rede, serie')} FROM silver_s)""",
    "running_share": """SELECT n_name, municipios,
            round(100.0::DOUBLE * municipios / sum(municipios) OVER (), 6) AS percentual,
            round(100.0::DOUBLE * sum(municipios) OVER (ORDER BY municipios DESC, n_name
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                / sum(municipios) OVER (), 6) AS acumulado
        FROM (SELECT n_name, count(*) AS municipios FROM supplier
            JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name)""",
    # order and distinct rows
    "top_n": """SELECT id_municipio, serie, ano, rede, taxa_alfabetizacao FROM silver_m
        ORDER BY taxa_alfabetizacao DESC NULLS LAST, id_municipio, serie, ano, rede LIMIT 10""",
    "dedup_rows": """SELECT DISTINCT concat(' ', id_municipio, ' ') AS id_municipio, ano,
        CAST(serie AS VARCHAR) AS serie, concat(' ', rede) AS rede,
        CAST(alfabetizado AS VARCHAR) AS alfabetizado FROM raw_pupil""",
    "dedup_by_key": """SELECT concat(' ', id_municipio, ' ') AS id_municipio, ano,
            proficiencia, id_aluno
        FROM raw_pupil QUALIFY row_number() OVER (PARTITION BY id_municipio, ano
            ORDER BY proficiencia DESC, id_aluno DESC) = 1""",
    "distinct_pairs": "SELECT DISTINCT escopo, rede, rede_descricao FROM goal",
    # data quality
    "profile": """SELECT sigla_uf, ano, count(*) AS registros,
            count(*) - count(nome_municipio) AS nulos_nome_municipio,
            count(*) - count(alfabetizado) AS nulos_alfabetizado,
            count(*) - count(peso_aluno) AS nulos_peso_aluno
        FROM pupil GROUP BY sigla_uf, ano""",
    "unmatched_rows": """SELECT count(*) AS registros,
        count(*) FILTER (WHERE nome_municipio IS NULL) AS sem_correspondencia FROM pupil""",
    "unmapped_codes": """SELECT 'rede' AS coluna,
            count(*) FILTER (WHERE rede = 4) AS sem_de_para FROM pupil
        UNION ALL SELECT 'serie', 0
        UNION ALL SELECT 'presenca', 0
        UNION ALL SELECT 'preenchimento_caderno',
            count(*) FILTER (WHERE preenchimento_caderno = 0) FROM pupil
        UNION ALL SELECT 'alfabetizado',
            count(*) FILTER (WHERE alfabetizado IS NULL) FROM pupil""",
    "write_checks": """SELECT 'alunos' AS tabela, verificacao, valor FROM (UNPIVOT (
            SELECT count(*) AS registros,
                count(*) FILTER (WHERE nome_municipio IS NULL) AS sem_correspondencia,
                count(*) FILTER (WHERE rede = 4) AS sem_de_para_rede,
                CAST(0 AS BIGINT) AS sem_de_para_serie, CAST(0 AS BIGINT) AS sem_de_para_presenca,
                count(*) FILTER (WHERE preenchimento_caderno = 0)
                    AS sem_de_para_preenchimento_caderno,
                count(*) FILTER (WHERE alfabetizado IS NULL) AS sem_de_para_alfabetizado
            FROM pupil) ON COLUMNS(*) INTO NAME verificacao VALUE valor)
        UNION ALL SELECT 'municipio', verificacao, valor FROM (UNPIVOT (
            SELECT count(*) AS registros,
                count(*) FILTER (WHERE nome_municipio IS NULL) AS sem_correspondencia,
                count(*) FILTER (WHERE rede = 4) AS sem_de_para_rede,
                CAST(0 AS BIGINT) AS sem_de_para_serie
            FROM silver_m) ON COLUMNS(*) INTO NAME verificacao VALUE valor)
        UNION ALL SELECT 'uf', verificacao, valor FROM (UNPIVOT (
            SELECT count(*) AS registros, count(*) FILTER (WHERE rede = 4) AS sem_de_para_rede,
                CAST(0 AS BIGINT) AS sem_de_para_serie
            FROM silver_s) ON COLUMNS(*) INTO NAME verificacao VALUE valor)""",
    "column_contract": """SELECT 'alunos' AS tabela, coluna, registros
        FROM (SELECT count(*) AS registros FROM raw_pupil), (VALUES ('nome_municipio'),
            ('sigla_uf'), ('ano_referencia'), ('serie_descricao'), ('rede_descricao')) AS v(coluna)
        UNION ALL SELECT 'municipio', coluna, registros
        FROM (SELECT count(*) AS registros FROM silver_m), (VALUES ('nome_municipio'),
            ('sigla_uf'), ('ano_referencia'), ('serie_descricao'), ('rede_descricao')) AS v(coluna)""",
    "unmapped_texts": """SELECT rede_descricao, count(*) AS registros FROM goal
        WHERE rede IS NULL GROUP BY rede_descricao""",
    "key_quality": """SELECT count(*) + 1 AS registros,
            count(DISTINCT id_municipio) AS chaves_distintas,
            CAST(0 AS BIGINT) AS nulos_id_municipio,
            CAST(0 AS BIGINT) AS nulos_nome_municipio,
            CAST(0 AS BIGINT) AS nulos_sigla_uf FROM locality""",
    # events
    "event_unwrap": """SELECT event_id, 0 AS ordem, ano, rede, value AS taxa_alfabetizacao
        FROM goal_event WHERE forma <= 5""",
    "event_quarantine": """SELECT event_id,
            CASE forma WHEN 7 THEN 'formato nao suportado' ELSE 'vazio' END AS motivo,
            CASE forma WHEN 6 THEN '{}' WHEN 7 THEN '{"metas":"nada"}'
                ELSE '{"metas":[]}' END AS value
        FROM goal_event WHERE forma > 5""",
    "goal_map_explode": """SELECT event_id, ano, rede, CAST(y AS INTEGER) AS ano_meta,
            value + y - 1995 AS meta_alfabetizacao
        FROM goal_event JOIN range(1996, 2003) AS r(y) ON y > ano
        WHERE forma <= 5""",
    "latest_goal": """SELECT ano, rede, arg_max(value, event_id) AS taxa_alfabetizacao
        FROM goal_event WHERE forma <= 5 GROUP BY ano, rede""",
    "stream_ingest": """SELECT ano, rede, CAST(y AS INTEGER) AS ano_meta,
            value + y - 1995 AS meta_alfabetizacao
        FROM goal_event JOIN range(1996, 2003) AS r(y) ON y > ano
        WHERE forma <= 5""",
    "stream_acknowledgement": """SELECT count(*) AS eventos,
            count(*) FILTER (WHERE forma <= 5) AS metas FROM goal_event""",
    "stream_refresh": COMPARISON_C.replace("JOIN goal g", "JOIN goal_now g"),
    "run_pipeline": " UNION ALL ".join(
        f"SELECT '{table}' AS conjunto, count(*) AS registros FROM ({source})"
        for table, source in {
            "alunos": "SELECT * FROM pupil", "municipio": "SELECT * FROM silver_m",
            "uf": "SELECT * FROM silver_s", "meta_alfabetizacao": "SELECT * FROM goal",
            "indicador_municipio": "SELECT * FROM municipality",
            "indicador_uf": "SELECT * FROM state", "indicador_brasil": "SELECT * FROM country",
            "metas_vs_resultado_municipio": COMPARISON_M, "metas_vs_resultado_uf": COMPARISON_S,
            "metas_vs_resultado_brasil": COMPARISON_C,
            "evolucao_temporal_municipio": "SELECT * FROM municipality",
            "evolucao_temporal_uf": "SELECT * FROM state",
            "evolucao_temporal_brasil": "SELECT * FROM country", "ml_aluno": FEATURES,
        }.items()
    ),
    # tables
    "silver_state": "SELECT * FROM silver_s",
    "silver_municipality": "SELECT * FROM silver_m",
    "silver_pupil": f"SELECT *, {PUPIL_TEXTS} FROM pupil",
    "silver_goal": "SELECT * FROM goal",
    "indicator_finalize": f"""SELECT sigla_uf, {RATES}, 'uf' AS nivel_geografico,
        ano_referencia AS ano FROM silver_s""",
    "gold_indicator_municipality": "SELECT * FROM municipality",
    "gold_indicator_state": "SELECT * FROM state",
    "gold_indicator_total": "SELECT * FROM country",
    "gold_goal_vs_result_municipality": COMPARISON_M,
    "gold_goal_vs_result_state": COMPARISON_S,
    "gold_goal_vs_result_total": COMPARISON_C,
    "gold_evolution_municipality": _evolution("municipality", "municipio", "id_municipio"),
    "gold_evolution_state": _evolution("state", "uf", "sigla_uf"),
    "gold_evolution_total": _evolution("country", "brasil", None),
    "gold_ml_features": FEATURES,
    "gold_ml_features_murmur": f"""SELECT * EXCLUDE (dataset_split, faixa),
            {MURMUR_SPLIT} AS dataset_split
        FROM (SELECT *, {_murmur('id_aluno')} AS faixa FROM ({FEATURES}))""",
    # reports
    "q1_result_vs_goal": Q1,
    "q2_goal_reached": f"{Q1} AND atingiu_meta",
    "q3_distance_by_goal_year": f"""SELECT ano_meta, count(*) AS municipios,
            count(*) FILTER (WHERE atingiu_meta) AS ja_alcancam_a_meta,
            round(100.0::DOUBLE * count(*) FILTER (WHERE atingiu_meta) / count(*), 1)
                AS percentual_que_alcanca,
            round(avg(meta_alfabetizacao), 1) AS meta_media,
            round(avg(taxa_alfabetizacao), 1) AS taxa_media_observada,
            round(avg(gap_pp), 1) + 0.0::DOUBLE AS gap_medio_pp,
            round(quantile_disc(gap_pp, 0.5), 1) + 0.0::DOUBLE AS gap_mediano_pp
        FROM comparison_m WHERE ano = {YEAR} AND escopo_meta = 'municipio'
            AND rede_descricao = 'Municipal' GROUP BY ano_meta""",
    "q4_state_ranking": f"""SELECT sigla_uf, ano_meta,
            round(taxa_alfabetizacao, 1) AS taxa_alfabetizacao,
            round(meta_alfabetizacao, 1) AS meta_alfabetizacao,
            round(gap_pp, 1) + 0.0::DOUBLE AS gap_pp,
            round(percentual_da_meta, 1) AS percentual_da_meta,
            atingiu_meta, meta_ja_vencida,
            count(*) FILTER (WHERE atingiu_meta) OVER (PARTITION BY sigla_uf)
                AS degraus_alcancados,
            round(max(CASE WHEN ano_meta = {FINAL} THEN gap_pp END)
                OVER (PARTITION BY sigla_uf), 1) + 0.0::DOUBLE AS gap_2030_pp
        FROM comparison_s WHERE ano = {YEAR} AND escopo_meta = 'uf'""",
    "q5_states_below": f"""SELECT sigla_uf, municipios_com_meta, municipios_abaixo,
            round(100.0::DOUBLE * municipios_abaixo / municipios_com_meta, 1)
                AS percentual_abaixo,
            round(100.0::DOUBLE * municipios_abaixo / nullif(sum(municipios_abaixo) OVER (), 0), 1)
                AS percentual_do_total,
            round(100.0::DOUBLE * sum(municipios_abaixo) OVER (
                ORDER BY municipios_abaixo DESC, sigla_uf NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                / nullif(sum(municipios_abaixo) OVER (), 0), 1) AS acumulado_nacional,
            round(gap_abaixo, 1) + 0.0::DOUBLE AS gap_medio_dos_abaixo,
            round(pior, 1) + 0.0::DOUBLE AS pior_gap_pp
        FROM (SELECT sigla_uf, count(*) AS municipios_com_meta,
                count(*) FILTER (WHERE NOT atingiu_meta) AS municipios_abaixo,
                avg(gap_pp) FILTER (WHERE NOT atingiu_meta) AS gap_abaixo,
                min(gap_pp) AS pior
            FROM comparison_m WHERE ano = {YEAR} AND ano_meta = {YEAR}
                AND escopo_meta = 'municipio' GROUP BY sigla_uf)""",
    "q6_state_spread": f"""SELECT sigla_uf, municipios, municipios_comparaveis,
            round(taxa, 1) AS taxa_media_municipal,
            round(media, 1) + 0.0::DOUBLE AS media_vs_brasil_pp,
            round(mediana, 1) + 0.0::DOUBLE AS mediana_vs_brasil_pp,
            municipios_acima_do_brasil,
            round(100.0::DOUBLE * municipios_acima_do_brasil
                / nullif(municipios_comparaveis, 0), 1) AS percentual_acima_do_brasil,
            round(desvio, 1) AS desvio_interno_pp,
            round(p10, 1) + 0.0::DOUBLE AS p10_vs_uf_pp,
            round(p90, 1) + 0.0::DOUBLE AS p90_vs_uf_pp,
            round(p90 - p10, 1) AS amplitude_p10_p90_pp,
            round(max(media) OVER (PARTITION BY serie)
                - min(media) OVER (PARTITION BY serie), 1) AS amplitude_entre_ufs_pp,
            round(avg(p90 - p10) OVER (PARTITION BY serie), 1) AS amplitude_interna_media_pp
        FROM (SELECT sigla_uf, serie, count(*) AS municipios,
                count(diferenca_pp_vs_brasil) AS municipios_comparaveis,
                avg(taxa_alfabetizacao) AS taxa,
                avg(diferenca_pp_vs_brasil) AS media,
                quantile_disc(diferenca_pp_vs_brasil, 0.5) AS mediana,
                count(*) FILTER (WHERE diferenca_pp_vs_brasil > 0)
                    AS municipios_acima_do_brasil,
                stddev(diferenca_pp_vs_uf) AS desvio,
                quantile_disc(diferenca_pp_vs_uf, 0.1) AS p10,
                quantile_disc(diferenca_pp_vs_uf, 0.9) AS p90
            FROM municipality WHERE ano = {YEAR} AND rede_descricao = 'Municipal'
                AND taxa_alfabetizacao IS NOT NULL
            GROUP BY sigla_uf, serie, serie_descricao)""",
    "q7_national_goal_vs_result": COMPARISON_C,
    "q8_national_indicator": "SELECT * FROM country",
    "q9_national_evolution": _evolution("country", "brasil", None),
}

# The same results by another way of joining.
STATEMENTS["compare_to_parent_large"] = STATEMENTS["compare_to_parent"]
STATEMENTS["dim_enrich_large"] = STATEMENTS["dim_enrich"]

ORACLE = {name: _with(sql) for name, sql in STATEMENTS.items()}
