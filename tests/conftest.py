import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from casecast.session import checkpoint_dir, local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("casecast-tests", 4, "4g", **{"spark.checkpoint.dir": folder})
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("OFF")
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


EDGE_LINES = """\
sexo,edad,fecha_inicio_sintomas,fecha_internacion,cuidado_intensivo,asistencia_respiratoria_mecanica,clasificacion,fecha_diagnostico,clasificacion_resumen
M,40,2020-05-01,2020-05-04,SI,NO,Caso confirmado - Fallecido,2020-05-06,Confirmado
M,,2020-05-01,2020-05-02,NO,NO,Caso confirmado - No activo,,Confirmado
F,31,2020-05-01,,NO,SI,Caso confirmado - fallecido,2020-05-03,Confirmado
F,30,2020-05-03,2020-05-01,si,SI,,2020-05-03,Confirmado
NR,,,2020-05-01,NO,NO,Fallecido,2020-05-03,Confirmado
,50,2020-05-01,2020-05-09,SI,SI,Fallecido,2020-05-03,Confirmado
M,99,2020-05-01,2020-05-04,SI,NO,x,2020-05-06,Descartado
"""


@pytest.fixture(scope="session")
def edge_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("edge") / "cases.csv"
    path.write_text(EDGE_LINES)
    return str(path)


@pytest.fixture(scope="session")
def edge_cases(spark, edge_csv):
    from casecast.sources import read_cases_csv

    return read_cases_csv(spark, edge_csv)
