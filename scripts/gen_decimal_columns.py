"""Regenerate ledgerlark/oracle/decimal_columns.py from the Spark query schemas."""
import pprint
import sys

from pyspark.sql import types as T

from ledgerlark.plans.registry import SPARK
from ledgerlark.plans.warehouse import Warehouse
from ledgerlark.session import local_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = local_session()
wh = Warehouse.from_driver_tables(spark, sf)
out = {}
for name, fn in SPARK.items():
    dec = [f.name for f in fn(wh).schema.fields if isinstance(f.dataType, T.DecimalType)]
    if dec:
        out[name] = dec
with open("ledgerlark/oracle/decimal_columns.py", "w") as fh:
    fh.write('"""Generated by scripts/gen_decimal_columns.py: DECIMAL output columns per query."""\n\n')
    fh.write("DECIMAL_COLUMNS = " + pprint.pformat(out, width=110) + "\n")
print(out)
