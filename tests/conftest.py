from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Eight sound orders of four customers. With 2023-03-31 as latest day the periods
# begin on 2023-03-01, 2022-10-01 and 2022-04-01; days on and just before each are here.
CLEAN_CSV = """row_id,order_id,order_date,ship_date,ship_mode,customer_id,customer_name,segment,country,city
101,KX-1,2023-03-31,2023-03-31,same day,K-1,Mira Oduya,Consumer,Kenya,Kisumu
102,KX-2,2023-03-02,2023-03-09,Standard Class,K-1,Mira Oduya,Consumer,Kenya,Kisumu
103,KX-3,2022-10-01,2022-10-04,Second Class,K-1,Mira Oduya,Consumer,Kenya,Nakuru
104,KX-4,2022-04-01,2022-04-02,FIRST CLASS,K-1,Mira Oduya,Consumer,Kenya,Kisumu
105,KX-5,2023-03-01,2023-03-05,Standard Class,K-2,Teo van der Berg,Corporate,Belgium,Gent
106,KX-6,2022-09-30,2022-10-02,First Class,K-2,Teo van der Berg,Corporate,Belgium,Gent
107,KX-7,2022-03-31,2022-04-06,Second Class,K-3,Cher,Home Office,France,Lyon
108,KX-8,2023-02-28,2023-03-01,First Class,K-4,ana  silva,Consumer,brazil,Recife
"""

# Three sound orders, then one defect a row (two rows for each repeated key).
DIRTY_CSV = """row_id,order_id,order_date,ship_date,ship_mode,customer_id,customer_name,segment,country,city
201,DX-01,2024-05-01,2024-05-01,Same Day,D-1,Ivo Horvat,Consumer,Croatia,Split
202,DX-02,2024-05-03,2024-05-06,First Class,D-2,Lena Brandt,Corporate,Austria,Graz
203,DX-03,2024-05-07,2024-05-09,Second Class,D-3,Omar Haddad,Home Office,Tunisia,Sfax
204,DX-04,2024-05-08,2024-05-09,By Pigeon,D-4,Pia Lund,Consumer,Norway,Bergen
205,DX-05,2024-05-09,2024-05-02,First Class,D-5,Raj Nair,Consumer,India,Kochi
206,DX-06,soon,2024-05-11,Same Day,D-6,Sol Vega,Consumer,Chile,Arica
207,DX-07,2024-05-11,2024-13-40,First Class,D-7,Uma Rao,Consumer,India,Mysuru
208,DX-08,2024-05-12,2024-05-13,First Class,,Ville Aalto,Consumer,Finland,Turku
209,DX-09,2024-05-13,2024-05-14,First Class,D-9,,Consumer,Peru,Cusco
210,DX-10,2024-05-14,2024-05-15,First Class,D-10,Xenia Popa,,Romania,Cluj
211,DX-11,2024-05-15,2024-05-16,First Class,D-11,Yara Costa,Consumer,,Faro
212,DX-12,2024-05-16,2024-05-17,First Class,D-12,Zoe Quinn,Consumer,Ireland,
213,DX-13,2024-05-17,2024-05-18,Same Day,D-13,Abel Tut,Consumer,Egypt,Giza
213,DX-14,2024-05-18,2024-05-19,Same Day,D-14,Bea Kiss,Consumer,Hungary,Pecs
214,DX-15,2024-05-19,2024-05-20,Same Day,D-15,Carl Juhl,Consumer,Denmark,Odense
215,DX-15,2024-05-20,2024-05-21,Same Day,D-16,Dana Levi,Consumer,Israel,Haifa
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_text(path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.fixture
def clean_csv(tmp_path):
    return write_text(tmp_path / "in" / "sales.csv", CLEAN_CSV)


@pytest.fixture
def dirty_csv(tmp_path):
    return write_text(tmp_path / "in" / "new_sales.csv", DIRTY_CSV)
