"""How many runs of one to four words two lists of words share: a JVM function, compiled by Spark's own compiler.

Spark's array functions look at one element of an array in about a microsecond when elements must be counted; this one
counts a whole text in plain loops. Its source is below; the driver compiles it once and gives the class to the executors.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.classic.column import _to_java_column, _to_seq

NAME, CLASS = "reportloom_shared_runs", "reportloom.SharedRuns"
SOURCE = """
package reportloom;

public class SharedRuns implements org.apache.spark.sql.api.java.UDF2, java.io.Serializable {
    static final int ORDERS = 4;

    public org.apache.spark.sql.expressions.UserDefinedFunction function(String name) {
        org.apache.spark.sql.api.java.UDF2 self = this;
        org.apache.spark.sql.types.DataType numbers = org.apache.spark.sql.types.DataTypes.createArrayType(
            org.apache.spark.sql.types.DataTypes.LongType);
        return org.apache.spark.sql.functions.udf(self, numbers).withName(name);
    }

    /** Words, set apart by single blanks, as numbers; equal words have equal numbers. */
    static int[] words(String text, java.util.HashMap known) {
        int n = text.length() == 0 ? 0 : 1;
        for (int at = text.indexOf(' '); at >= 0; at = text.indexOf(' ', at + 1)) n++;
        int[] out = new int[n];
        int at = 0;
        for (int k = 0; k < n; k++) {
            int end = text.indexOf(' ', at);
            if (end < 0) end = text.length();
            String word = text.substring(at, end);
            Object number = known.get(word);
            if (number == null) {
                number = Integer.valueOf(known.size());
                known.put(word, number);
            }
            out[k] = ((Integer) number).intValue();
            at = end + 1;
        }
        return out;
    }

    /** Of runs[i], a run of n words from i, to the number of the run with one word more; equal runs get equal numbers. */
    static int longer(int[] runs, int[] words, int n, long[] keys, int[] numbers, int next) {
        int mask = keys.length - 1;
        for (int i = 0; i + n < words.length; i++) {
            long key = ((long) runs[i] << 32) | words[i + n];
            long mixed = key * 0x9E3779B97F4A7C15L;
            int at = (int) (mixed >>> 32) & mask;
            while (numbers[at] > 0 && keys[at] != key) at = (at + 1) & mask;
            if (numbers[at] == 0) {
                keys[at] = key;
                numbers[at] = ++next;
            }
            runs[i] = numbers[at] - 1;
        }
        return next;
    }

    /** Per length of runs how many both texts share, each as often as in the text that has it less often. */
    public Object call(Object first, Object second) {
        java.util.HashMap known = new java.util.HashMap();
        int[] a = words((String) first, known);
        int[] b = words((String) second, known);
        int[] x = new int[a.length];
        int[] y = new int[b.length];
        System.arraycopy(a, 0, x, 0, a.length);
        System.arraycopy(b, 0, y, 0, b.length);
        long[] shared = new long[ORDERS];
        int different = known.size();
        for (int n = 1; n <= ORDERS && n <= a.length && n <= b.length; n++) {
            int[] free = new int[different];
            for (int i = 0; i + n <= a.length; i++) free[x[i]]++;
            for (int i = 0; i + n <= b.length; i++) {
                if (free[y[i]] > 0) {
                    free[y[i]]--;
                    shared[n - 1]++;
                }
            }
            if (shared[n - 1] == 0) break;
            int size = Integer.highestOneBit(a.length + b.length) << 2;
            long[] keys = new long[size];
            int[] numbers = new int[size];
            different = longer(x, a, n, keys, numbers, 0);
            different = longer(y, b, n, keys, numbers, different);
        }
        return shared;
    }
}
"""


def _function() -> JavaObject:
    """The function of this Spark context, compiled when first asked for."""
    context = SparkContext._active_spark_context
    if not getattr(context, "_reportloom_shared_runs", None):
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(SOURCE)
        packed = Path(tempfile.mkdtemp(prefix="reportloom-")).resolve() / "shared-runs.jar"  # read by the driver only
        compiled = compiler.getBytecodes()
        with zipfile.ZipFile(packed, "w") as out:
            for name in compiled:
                out.writestr(name.replace(".", "/") + ".class", bytes(compiled[name]))
        context._jsc.addJar(str(packed))
        # Called from here, udf() may as well take the class for a Scala function.
        context._reportloom_shared_runs = compiler.getClassLoader().loadClass(CLASS).newInstance().function(NAME)
    return context._reportloom_shared_runs


def shared_runs(reference: Column, prediction: Column) -> Column:
    """Array of four numbers for two arrays of words, none of which holds a blank."""
    texts = [F.array_join(reference, " "), F.array_join(prediction, " ")]
    return Column(_function().apply(_to_seq(SparkContext._active_spark_context, texts, _to_java_column)))
