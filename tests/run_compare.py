"""Compare all or the named queries: python tests/run_compare.py [folder] [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from quillframe.session import local_session  # noqa: E402
from tests.compare import difference  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = local_session("compare", memory="16g")
spark.sparkContext.setLogLevel("ERROR")
oracles = entry.oracle_sql()
for name, function in entry.queries().items():
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    start = time.time()
    try:
        df = function(spark, folder)
        bad = difference(df, folder, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
    except Exception as error:  # noqa: BLE001
        bad = "".join(traceback.format_exception_only(error))[:600]
        if len(sys.argv) > 2:
            traceback.print_exc()
    print(f"{'ok  ' if bad is None else 'BAD '} {name} {time.time() - start:.1f}s {bad or ''}", flush=True)
