"""The loops of boosting as Java, compiled by Spark's own compiler.

Adding up a level's gradients cell by cell is what a fit spends its time on, and
NumPy goes through the rows several times for it. ``grown`` runs the same
steps as ``boosting.grow`` in a barrier stage of the JVM: ``SOURCE`` is compiled by
Janino, which Spark brings for its generated code, and sent to the executors as
a jar. Sums are whole numbers as there; only the last digit of ``exp`` may differ.
A task keeps its rows in the order of their nodes, and adds up the lighter child of a node.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

SOURCE = r"""
package cardsight;

import java.io.ByteArrayOutputStream;
import java.nio.ByteBuffer;
import java.util.ArrayList;
import java.util.Arrays;
import java.util.Base64;
import java.util.Collections;
import java.util.zip.Deflater;
import java.util.zip.DeflaterOutputStream;
import java.util.zip.Inflater;
import org.apache.spark.BarrierTaskContext;
import org.apache.spark.sql.Row;

/** Rows (label, bins by feature) of a task to the trees that all tasks grow, given out by the first. */
public class Grower extends scala.runtime.AbstractFunction1 implements java.io.Serializable {
    private final int[] offset;  // of each feature's cells, then their number
    private final int most, rounds, depth, tasks, unitBits;
    private final double rate, l2;
    private final byte[] begun;

    private transient BarrierTaskContext context;
    private transient int n, width, cells;
    private transient byte[][] bins;
    private transient char[] rows;  // for each row and feature the place of its cell among a node's sums
    private transient double[] label, margin;
    private transient int[] gh, order, other;
    private transient long[] sums, next, added;

    public Grower(int[] offset, int most, int rounds, int depth, int tasks, int unitBits, double rate, double l2, byte[] begun) {
        this.offset = offset; this.most = most; this.rounds = rounds; this.depth = depth; this.tasks = tasks;
        this.unitBits = unitBits; this.rate = rate; this.l2 = l2; this.begun = begun;
    }

    public Object apply(Object given) {
        context = BarrierTaskContext.get();
        hold((scala.collection.Iterator) given);
        ByteBuffer before = ByteBuffer.wrap(begun);
        while (before.hasRemaining()) {
            int levels = before.getInt();
            int[] f = new int[levels], b = new int[levels];
            for (int l = 0; l < levels; l++) { f[l] = before.getInt(); b[l] = before.getInt(); }
            double[] values = new double[1 << levels];
            for (int i = 0; i < values.length; i++) values[i] = before.getDouble();
            move(f, b, levels, values);
        }
        ArrayList found = new ArrayList();
        ByteArrayOutputStream out = new ByteArrayOutputStream();
        try {
            for (int r = 0; r < rounds; r++) out.write(grow());
        } catch (java.io.IOException e) {
            throw new RuntimeException(e);
        }
        if (context.partitionId() == 0) found.add(out.toByteArray());  // all tasks hold the same trees
        return scala.jdk.javaapi.CollectionConverters.asScala(found.iterator());
    }

    private void hold(scala.collection.Iterator given) {
        ArrayList labels = new ArrayList(), parts = new ArrayList();
        long total = 0;
        while (given.hasNext()) {
            Row row = (Row) given.next();
            byte[] y = (byte[]) row.get(0);
            labels.add(y);
            parts.add((byte[]) row.get(1));
            total += y.length / 8;
        }
        width = offset.length - 1;
        cells = offset[width];
        n = Math.toIntExact(total);
        Math.multiplyExact(n, Math.max(2, width));
        bins = new byte[width][n];
        rows = new char[n * width];
        label = new double[n];
        int at = 0;
        for (int k = 0; k < labels.size(); k++) {
            ByteBuffer y = ByteBuffer.wrap((byte[]) labels.get(k)).order(java.nio.ByteOrder.LITTLE_ENDIAN);
            byte[] x = (byte[]) parts.get(k);
            labels.set(k, null); parts.set(k, null);
            int m = y.remaining() / 8;
            for (int i = 0; i < m; i++) label[at + i] = y.getDouble();
            for (int f = 0; f < width; f++) {
                System.arraycopy(x, f * m, bins[f], at, m);
                for (int i = 0; i < m; i++) rows[(at + i) * width + f] = (char) (2 * (offset[f] + (x[f * m + i] & 255)));
            }
            at += m;
        }
        margin = new double[n];
        gh = new int[2 * n];
        order = new int[n];
        other = new int[n];
        sums = new long[0]; next = new long[0]; added = new long[0];
    }

    private static long[] room(long[] held, int nodes, int size) {
        int wanted = Math.multiplyExact(nodes, size);
        return held.length >= wanted ? held : new long[Math.max(wanted, (int) Math.min(2L * held.length, 1 << 24))];
    }

    private static void gradients(double[] margin, double[] label, int[] gh, double unit) {
        for (int i = 0; i < margin.length; i++) {
            double p = 1.0 / (1.0 + Math.exp(-margin[i]));
            gh[2 * i] = (int) Math.rint((label[i] - p) * unit);
            gh[2 * i + 1] = (int) Math.rint(p * (1 - p) * unit);
        }
    }

    /** Adds the rows' gradients to a node's cells, five features at a time. */
    private static void add(char[] rows, int width, int[] gh, int[] order, int from, int to, long[] out) {
        for (int i = from; i < to; i++) {
            int at = order[i], c = at * width, end = c + width;
            long g = gh[2 * at], h = gh[2 * at + 1];
            for (; c + 5 <= end; c += 5) {
                int v = rows[c], w = rows[c + 1], x = rows[c + 2], y = rows[c + 3], z = rows[c + 4];
                out[v] += g; out[v + 1] += h;
                out[w] += g; out[w + 1] += h;
                out[x] += g; out[x + 1] += h;
                out[y] += g; out[y + 1] += h;
                out[z] += g; out[z + 1] += h;
            }
            for (; c < end; c++) {
                int v = rows[c];
                out[v] += g; out[v + 1] += h;
            }
        }
    }

    /** Score of the best split into at[0] (feature) and at[1] (border, -1 where no split is as good); that of none is left in whole[0]. */
    private static double best(long[] sums, int nodes, int width, int[] offset, int most, double l2, double unit, int[] at, double[] whole) {
        int cells = offset[width], first = width > 0 ? offset[1] : 0;
        double[] left = new double[cells], right = new double[cells];
        double none = 0.0;
        for (int k = 0; k < nodes; k++) {
            int s = 2 * cells * k;
            long gt = 0, ht = 0;
            for (int c = 0; c < first; c++) { gt += sums[s + 2 * c]; ht += sums[s + 2 * c + 1]; }
            for (int f = 0; f < width; f++) {
                long g = 0, h = 0;
                for (int c = offset[f]; c + 1 < offset[f + 1]; c++) {
                    g += sums[s + 2 * c];
                    h += sums[s + 2 * c + 1];
                    double gl = g / unit, hl = h / unit, gr = (gt - g) / unit, hr = (ht - h) / unit;
                    left[c] += gl * gl / (hl + l2);
                    right[c] += gr * gr / (hr + l2);
                }
            }
            double g = gt / unit, h = ht / unit;
            none += g * g / (h + l2);
        }
        double best = -1.0;
        at[0] = 0; at[1] = -1;
        for (int f = 0; f < width; f++) {
            for (int c = offset[f]; c + 1 < offset[f + 1]; c++)
                if (left[c] + right[c] > best) { best = left[c] + right[c]; at[0] = f; at[1] = c - offset[f]; }
            if (offset[f + 1] - offset[f] - 1 < most && none > best) { best = none; at[0] = f; at[1] = -1; }
        }
        whole[0] = none;
        return best;
    }

    private static int above(byte[] bins, int border, int[] order, int from, int to) {
        int found = 0;
        for (int i = from; i < to; i++) found += (border - (bins[order[i]] & 255)) >>> 31;
        return found;
    }

    /** The rows of a node into its children's places, in order; a place of -1 is no child. */
    private static void divide(byte[] bins, int border, int[] order, int from, int to, int l, int r, int[] out) {
        if (l >= 0 && r >= 0) {
            for (int i = from; i < to; i++) {
                int row = order[i], up = (border - (bins[row] & 255)) >> 31;  // -1 or 0: a branch would be guessed wrong
                out[l ^ ((l ^ r) & up)] = row;
                l += 1 + up;
                r -= up;
            }
            return;
        }
        for (int i = from; i < to; i++) {
            int row = order[i];
            if ((bins[row] & 255) > border) { if (r >= 0) out[r++] = row; } else if (l >= 0) out[l++] = row;
        }
    }

    /** Sums of one task into those of all. */
    private void total(long[] of, int size) {
        if (tasks == 1) return;
        try {
            ByteBuffer plain = ByteBuffer.allocate(Math.multiplyExact(8, size));
            plain.asLongBuffer().put(of, 0, size);
            ByteArrayOutputStream packed = new ByteArrayOutputStream();
            DeflaterOutputStream to = new DeflaterOutputStream(packed, new Deflater(1));
            to.write(plain.array());
            to.close();
            String[] all = context.allGather(Base64.getEncoder().encodeToString(packed.toByteArray()));
            Arrays.fill(of, 0, size, 0L);
            byte[] read = plain.array();
            for (int t = 0; t < all.length; t++) {
                Inflater from = new Inflater();
                from.setInput(Base64.getDecoder().decode(all[t]));
                int done = 0;
                while (done < read.length) done += from.inflate(read, done, read.length - done);
                from.end();
                java.nio.LongBuffer one = ByteBuffer.wrap(read).asLongBuffer();
                for (int i = 0; i < size; i++) of[i] += one.get(i);
            }
        } catch (java.io.IOException e) {
            throw new RuntimeException(e);
        } catch (java.util.zip.DataFormatException e) {
            throw new RuntimeException(e);
        }
    }

    private void move(int[] f, int[] b, int levels, double[] values) {
        int part = 4096;
        int[] leaf = new int[part];
        for (int s = 0; s < n; s += part) {
            int m = Math.min(part, n - s);
            Arrays.fill(leaf, 0);
            for (int l = 0; l < levels; l++) answers(bins[f[l]], s, m, b[l], l, leaf);
            for (int i = 0; i < m; i++) margin[s + i] += values[leaf[i]];
        }
    }

    private static void answers(byte[] x, int s, int m, int border, int level, int[] leaf) {
        for (int i = 0; i < m; i++) leaf[i] |= ((border - (x[s + i] & 255)) >>> 31) << level;
    }

    private byte[] grow() {
        double unit = (double) (1L << unitBits);
        int size = 2 * cells;
        long[] node = new long[size];
        gradients(margin, label, gh, unit);
        for (int i = 0; i < n; i++) order[i] = i;
        int nodes = 1;
        int[] from = new int[]{0, n}, leafOf = new int[]{0};
        long[] whole = new long[2];  // sums of g and h of each node
        for (int i = 0; i < n; i++) { whole[0] += gh[2 * i]; whole[1] += gh[2 * i + 1]; }
        total(whole, 2);
        if (width > 0) {
            sums = room(sums, 1, size);
            add(rows, width, gh, order, 0, n, node);
            System.arraycopy(node, 0, sums, 0, size);
            total(sums, size);
        }
        int[] features = new int[depth], borders = new int[depth], at = new int[2];
        double[] none = new double[1];
        int levels = 0;
        for (int level = 0; level < depth && width > 0; level++) {
            double gain = best(sums, nodes, width, offset, most, l2, unit, at, none) - none[0];
            if (!(gain > 1e-12) || at[1] < 0) break;
            int f = at[0], b = at[1];
            features[level] = f;
            borders[level] = b;
            levels = level + 1;
            // Children that hold rows, in any task: those below the border, then those above.
            long[] below = new long[2 * nodes];
            int held = 0;
            int[] left = new int[nodes], right = new int[nodes];
            for (int k = 0; k < nodes; k++) {
                for (int c = offset[f]; c <= offset[f] + b; c++) {
                    below[2 * k] += sums[size * k + 2 * c];
                    below[2 * k + 1] += sums[size * k + 2 * c + 1];
                }
                left[k] = below[2 * k] != 0 || below[2 * k + 1] != 0 ? held++ : -1;
            }
            for (int k = 0; k < nodes; k++)
                right[k] = whole[2 * k] != below[2 * k] || whole[2 * k + 1] != below[2 * k + 1] ? held++ : -1;
            long[] children = new long[2 * held];
            int[] leaves = new int[held];
            for (int k = 0; k < nodes; k++) {
                if (left[k] >= 0) {
                    children[2 * left[k]] = below[2 * k];
                    children[2 * left[k] + 1] = below[2 * k + 1];
                    leaves[left[k]] = leafOf[k];
                }
                if (right[k] >= 0) {
                    children[2 * right[k]] = whole[2 * k] - below[2 * k];
                    children[2 * right[k] + 1] = whole[2 * k + 1] - below[2 * k + 1];
                    leaves[right[k]] = leafOf[k] | 1 << level;
                }
            }
            if (level + 1 < depth) {
                int[] starts = new int[held + 1], count = new int[held];
                for (int k = 0; k < nodes; k++) {
                    int up = above(bins[f], b, order, from[k], from[k + 1]);
                    if (left[k] >= 0) count[left[k]] = from[k + 1] - from[k] - up;
                    if (right[k] >= 0) count[right[k]] = up;
                }
                for (int c = 0; c < held; c++) starts[c + 1] = starts[c] + count[c];
                for (int k = 0; k < nodes; k++)
                    divide(bins[f], b, order, from[k], from[k + 1], left[k] < 0 ? -1 : starts[left[k]], right[k] < 0 ? -1 : starts[right[k]], other);
                int[] swap = order; order = other; other = swap;
                int wanted = 0;
                for (int k = 0; k < nodes; k++) if (left[k] >= 0 && right[k] >= 0) wanted++;
                added = room(added, wanted, size);
                next = room(next, held, size);
                int place = 0;
                for (int k = 0; k < nodes; k++)
                    if (left[k] >= 0 && right[k] >= 0) {
                        int c = lighter(children, left[k], right[k]);
                        Arrays.fill(node, 0L);
                        add(rows, width, gh, order, starts[c], starts[c + 1], node);
                        System.arraycopy(node, 0, added, size * place++, size);
                    }
                total(added, wanted * size);
                place = 0;
                for (int k = 0; k < nodes; k++) {
                    if (left[k] >= 0 && right[k] >= 0) {
                        int c = lighter(children, left[k], right[k]), rest = left[k] + right[k] - c;
                        System.arraycopy(added, size * place, next, size * c, size);
                        less(sums, size * k, added, size * place++, next, size * rest, size);
                    } else {
                        int c = Math.max(left[k], right[k]);
                        if (c >= 0) System.arraycopy(sums, size * k, next, size * c, size);
                    }
                }
                long[] old = sums; sums = next; next = old;
                from = starts;
            }
            nodes = held;
            whole = children;
            leafOf = leaves;
        }
        double[] values = new double[1 << levels];
        for (int i = 0; i < values.length; i++) values[i] = rate * 0.0 / (0.0 + l2);
        for (int k = 0; k < nodes; k++) values[leafOf[k]] = rate * (whole[2 * k] / unit) / (whole[2 * k + 1] / unit + l2);
        move(features, borders, levels, values);
        ByteBuffer out = ByteBuffer.allocate(4 + 8 * levels + 8 * values.length);
        out.putInt(levels);
        for (int l = 0; l < levels; l++) { out.putInt(features[l]); out.putInt(borders[l]); }
        for (int i = 0; i < values.length; i++) out.putDouble(values[i]);
        return out.array();
    }

    private static int lighter(long[] children, int left, int right) {
        return children[2 * right + 1] <= children[2 * left + 1] ? right : left;
    }

    private static void less(long[] a, int i, long[] b, int j, long[] out, int k, int size) {
        for (int c = 0; c < size; c++) out[k + c] = a[i + c] - b[j + c];
    }
}
"""

_LOCK = threading.Lock()
_CLASSES: dict[str, object] = {}


def _grower(spark: SparkSession):
    """The compiled class, sent to the executors once per application; None where it cannot be made."""
    sc = getattr(spark, "sparkContext", None)
    with _LOCK:
        if sc.applicationId not in _CLASSES:
            try:
                compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
                compiler.cook(SOURCE)
                codes = compiler.getBytecodes()
                jar = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cardsight-jar-")), "cardsight-grower.jar")
                with zipfile.ZipFile(jar, "w", zipfile.ZIP_DEFLATED) as out:
                    for name in list(codes):
                        out.writestr(name.replace(".", "/") + ".class", bytes(codes[name]))
                sc._jsc.addJar(jar)
                _CLASSES[sc.applicationId] = compiler.getClassLoader().loadClass("cardsight.Grower")
            except Exception:  # no such compiler in this Spark: NumPy does the same
                _CLASSES[sc.applicationId] = None
        return _CLASSES[sc.applicationId]


def written(trees: Sequence[tuple[Sequence[int], Sequence[int], Sequence[float]]]) -> bytes:
    """Trees (places of features, numbers of borders, values) as the stage reads them."""
    out = []
    for features, borders, values in trees:
        asked = np.array([*zip(features, borders)], ">i4").tobytes()
        out.append(np.array([len(features)], ">i4").tobytes() + asked + np.array(values, ">f8").tobytes())
    return b"".join(out)


def read(packed: bytes) -> list[tuple[list[int], list[int], list[float]]]:
    """The trees of ``written``."""
    out, at = [], 0
    while at < len(packed):
        levels = int(np.frombuffer(packed, ">i4", 1, at)[0])
        asked = np.frombuffer(packed, ">i4", 2 * levels, at + 4).reshape(levels, 2)
        values = np.frombuffer(packed, ">f8", 1 << levels, at + 4 + 8 * levels)
        out.append((asked[:, 0].tolist(), asked[:, 1].tolist(), values.tolist()))
        at += 4 + 8 * levels + 8 * (1 << levels)
    return out


def grown(
    rows: DataFrame, n_bins: Sequence[int], begun: bytes, rounds: int, depth: int, rate: float, l2: float, tasks: int, unit_bits: int
) -> bytes | None:
    """``rounds`` further trees on ``rows`` (``label``, ``bins``: see ``boosting.packed_rows``) in ``tasks``
    partitions; empty where there are no rows, None where this Spark has no such stage."""
    if 2 * sum(n_bins) > 1 << 16:  # a cell's place is a char
        return None
    spark = rows.sparkSession
    made = _grower(spark)
    if made is None:
        return None
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    offset = gateway.new_array(jvm.int, len(n_bins) + 1)
    for i, end in enumerate(np.cumsum([0, *n_bins]).tolist()):
        offset[i] = end
    whole = [max(n_bins, default=1) - 1, rounds, depth, tasks, unit_bits]
    args = gateway.new_array(jvm.java.lang.Object, 9)
    for i, arg in enumerate([offset, *whole, float(rate), float(l2), bytearray(begun)]):
        args[i] = arg
    stage = made.getConstructors()[0].newInstance(args)
    tag = jvm.scala.reflect.ClassTag.apply(jvm.java.lang.Class.forName("[B"))
    # The exchange behind it makes it a map stage: Spark restarts those, a barrier stage of results never.
    found = rows._jdf.toJavaRDD().rdd().barrier().mapPartitions(stage, False, tag).toJavaRDD().repartition(1).collect()
    return b"".join(bytes(x) for x in found)
