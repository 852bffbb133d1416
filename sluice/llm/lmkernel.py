"""The loops of :mod:`lmscore` in Java, for numpy passes over each array many times where a processor could keep it in registers.

They use the JDK's vectors of eight floats, whose module Spark opens on the driver and on executors. Spark's own compiler of
Java makes the class, which goes to the executors as a jar. Where executors can't run it, lmscore's numpy does the same
work by the same formulas over the same windows in the same order; the sums of the two differ by rounding.
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import SparkSession

SOURCE = r"""
import java.nio.ByteBuffer;
import java.nio.ByteOrder;
import java.util.Arrays;
import jdk.incubator.vector.FloatVector;
import jdk.incubator.vector.IntVector;
import jdk.incubator.vector.VectorOperators;
import jdk.incubator.vector.VectorSpecies;
import org.apache.spark.broadcast.Broadcast;
import org.apache.spark.sql.api.java.UDF2;

public class SluiceLanguageModel implements UDF2 {
    static final VectorSpecies S = FloatVector.SPECIES_256;
    static final int W = @WINDOW@, OVERLAP = @OVERLAP@, D = @WIDTH@, Q = 3 * D, ROW = D + 1, BLOCK = 32;
    static final float LEAST = @FLOOR@f, MOST = @MOST@f, SCALE = @SCALE@f, RATE = @RATE@f;
    /** From place 8 - n on: n zeros, then ones. */
    static final float[] LATER = new float[] {0f, 0f, 0f, 0f, 0f, 0f, 0f, 0f, 1f, 1f, 1f, 1f, 1f, 1f, 1f, 1f};

    final Broadcast sent;
    final int batch, chunk;

    public SluiceLanguageModel(Broadcast sent, int batch, int chunk) {
        this.sent = sent;
        this.batch = batch;
        this.chunk = chunk;
    }

    // what the broadcast says
    transient int item, size, bands, params;
    transient int[] rank, lo, hi, band;
    transient float[] flat, sq;
    transient int pos, qkv, o, out, emb, inner;
    // a batch: places have D values each, W places a window; shares of attention and logits have a row for each that is seen
    // or told, and the places that see or tell it beside each other, so that their sums need no sum across a vector
    transient float[] x, a3, att, mid, h, dh, log, outT, gout, ginner, gemb;
    transient int[] place, sorted, count, slot, held, target, own;
    transient float[] z, hb, hT, dT, total, best, bias, turned, ds, dmid, d, oT, qkvT, go, gqkv, gpos;

    static int wide(int m) {
        return (m + 7) / 8 * 8;
    }

    private void read(boolean training) {
        ByteBuffer b = ByteBuffer.wrap((byte[]) sent.value()).order(ByteOrder.LITTLE_ENDIAN);
        item = b.getInt();
        rank = new int[b.getInt()];
        size = b.getInt();
        bands = b.getInt();
        params = b.getInt();
        flat = new float[params + 4 * ROW]; // heads go by four rows, so the last may read three that don't count
        lo = new int[bands];
        hi = new int[bands];
        band = new int[size];
        for (int i = 0; i < rank.length; i++) { rank[i] = b.getInt(); }
        int most = bands;
        for (int i = 0; i < bands; i++) { lo[i] = b.getInt(); }
        for (int i = 0; i < bands; i++) {
            hi[i] = b.getInt();
            Arrays.fill(band, lo[i], hi[i], i);
            most = Math.max(most, hi[i] - lo[i]);
        }
        for (int i = 0; i < params; i++) { flat[i] = b.getFloat(); }
        pos = 0;
        qkv = pos + W * D;
        o = qkv + D * Q;
        out = o + D * D;
        emb = out + ROW * bands;
        inner = emb + (size + 1) * D;
        int n = batch * W;
        most += 4;
        x = new float[n * D];
        a3 = new float[n * Q];
        att = new float[n * W];
        mid = new float[n * D];
        h = new float[n * D];
        log = new float[n];
        outT = new float[(bands + 4) * ROW];
        place = new int[n];
        sorted = new int[n];
        own = new int[n];
        count = new int[bands + 1];
        target = new int[BLOCK];
        z = new float[BLOCK * most];
        hb = new float[BLOCK * D];
        hT = new float[ROW * BLOCK];
        dT = new float[D * BLOCK];
        Arrays.fill(hT, D * BLOCK, ROW * BLOCK, 1f);
        total = new float[BLOCK];
        best = new float[BLOCK];
        turned = new float[D * W];
        if (training) {
            sq = new float[params];
            Arrays.fill(sq, 1e-3f);
            dh = new float[n * D];
            bias = new float[most * 8];
            gout = new float[(bands + 4) * ROW];
            ginner = new float[most * ROW];
            gemb = new float[n * D];
            slot = new int[size + 1];
            Arrays.fill(slot, -1);
            held = new int[n];
            ds = new float[W * W];
            dmid = new float[W * D];
            d = new float[W * Q];
            oT = new float[D * D];
            qkvT = new float[Q * D];
            go = new float[D * D];
            gqkv = new float[D * Q];
            gpos = new float[W * D];
        }
    }

    /** y[p] += sum over k below n of x[p * xs + k] * w[k], for four p and sixteen columns. */
    static void product2(int n, float[] x, int xo, int xs, float[] w, int wo, int ws, float[] y, int yo, int ys) {
        FloatVector a0 = FloatVector.fromArray(S, y, yo), a1 = FloatVector.fromArray(S, y, yo + 8);
        FloatVector b0 = FloatVector.fromArray(S, y, yo + ys), b1 = FloatVector.fromArray(S, y, yo + ys + 8);
        FloatVector c0 = FloatVector.fromArray(S, y, yo + 2 * ys), c1 = FloatVector.fromArray(S, y, yo + 2 * ys + 8);
        FloatVector d0 = FloatVector.fromArray(S, y, yo + 3 * ys), d1 = FloatVector.fromArray(S, y, yo + 3 * ys + 8);
        for (int k = 0; k < n; k++) {
            FloatVector p = FloatVector.fromArray(S, w, wo + k * ws), q = FloatVector.fromArray(S, w, wo + k * ws + 8);
            FloatVector f = FloatVector.broadcast(S, x[xo + k]);
            a0 = f.fma(p, a0);
            a1 = f.fma(q, a1);
            f = FloatVector.broadcast(S, x[xo + xs + k]);
            b0 = f.fma(p, b0);
            b1 = f.fma(q, b1);
            f = FloatVector.broadcast(S, x[xo + 2 * xs + k]);
            c0 = f.fma(p, c0);
            c1 = f.fma(q, c1);
            f = FloatVector.broadcast(S, x[xo + 3 * xs + k]);
            d0 = f.fma(p, d0);
            d1 = f.fma(q, d1);
        }
        a0.intoArray(y, yo);
        a1.intoArray(y, yo + 8);
        b0.intoArray(y, yo + ys);
        b1.intoArray(y, yo + ys + 8);
        c0.intoArray(y, yo + 2 * ys);
        c1.intoArray(y, yo + 2 * ys + 8);
        d0.intoArray(y, yo + 3 * ys);
        d1.intoArray(y, yo + 3 * ys + 8);
    }

    /** As product2 for eight columns. */
    static void product1(int n, float[] x, int xo, int xs, float[] w, int wo, int ws, float[] y, int yo, int ys) {
        FloatVector a0 = FloatVector.fromArray(S, y, yo), b0 = FloatVector.fromArray(S, y, yo + ys);
        FloatVector c0 = FloatVector.fromArray(S, y, yo + 2 * ys), d0 = FloatVector.fromArray(S, y, yo + 3 * ys);
        for (int k = 0; k < n; k++) {
            FloatVector p = FloatVector.fromArray(S, w, wo + k * ws);
            a0 = FloatVector.broadcast(S, x[xo + k]).fma(p, a0);
            b0 = FloatVector.broadcast(S, x[xo + xs + k]).fma(p, b0);
            c0 = FloatVector.broadcast(S, x[xo + 2 * xs + k]).fma(p, c0);
            d0 = FloatVector.broadcast(S, x[xo + 3 * xs + k]).fma(p, d0);
        }
        a0.intoArray(y, yo);
        b0.intoArray(y, yo + ys);
        c0.intoArray(y, yo + 2 * ys);
        d0.intoArray(y, yo + 3 * ys);
    }

    static void product(int n, int columns, float[] x, int xo, int xs, float[] w, int wo, int ws, float[] y, int yo, int ys) {
        int c = 0;
        for (; c + 16 <= columns; c += 16) { product2(n, x, xo, xs, w, wo + c, ws, y, yo + c, ys); }
        if (c < columns) { product1(n, x, xo, xs, w, wo + c, ws, y, yo + c, ys); }
    }

    /** g[k] += sum over i below n of x[i * xs + k] * v[i], for four k and sixteen columns. */
    static void outer(int n, float[] x, int xo, int xs, float[] v, int vo, int vs, float[] g, int to, int gs) {
        FloatVector a0 = FloatVector.fromArray(S, g, to), a1 = FloatVector.fromArray(S, g, to + 8);
        FloatVector b0 = FloatVector.fromArray(S, g, to + gs), b1 = FloatVector.fromArray(S, g, to + gs + 8);
        FloatVector c0 = FloatVector.fromArray(S, g, to + 2 * gs), c1 = FloatVector.fromArray(S, g, to + 2 * gs + 8);
        FloatVector d0 = FloatVector.fromArray(S, g, to + 3 * gs), d1 = FloatVector.fromArray(S, g, to + 3 * gs + 8);
        for (int i = 0; i < n; i++) {
            FloatVector p = FloatVector.fromArray(S, v, vo + i * vs), q = FloatVector.fromArray(S, v, vo + i * vs + 8);
            int k = xo + i * xs;
            FloatVector f = FloatVector.broadcast(S, x[k]);
            a0 = f.fma(p, a0);
            a1 = f.fma(q, a1);
            f = FloatVector.broadcast(S, x[k + 1]);
            b0 = f.fma(p, b0);
            b1 = f.fma(q, b1);
            f = FloatVector.broadcast(S, x[k + 2]);
            c0 = f.fma(p, c0);
            c1 = f.fma(q, c1);
            f = FloatVector.broadcast(S, x[k + 3]);
            d0 = f.fma(p, d0);
            d1 = f.fma(q, d1);
        }
        a0.intoArray(g, to);
        a1.intoArray(g, to + 8);
        b0.intoArray(g, to + gs);
        b1.intoArray(g, to + gs + 8);
        c0.intoArray(g, to + 2 * gs);
        c1.intoArray(g, to + 2 * gs + 8);
        d0.intoArray(g, to + 3 * gs);
        d1.intoArray(g, to + 3 * gs + 8);
    }

    /** e to the x, for x from -80 to 80. */
    static FloatVector power(FloatVector x) {
        FloatVector t = x.mul(1.44269504f).add(12582912f);
        FloatVector n = t.sub(12582912f);
        FloatVector r = x.sub(n.mul(0.693359375f)).sub(n.mul(-2.12194440e-4f));
        FloatVector p = r.mul(1.9875691500e-4f).add(1.3981999507e-3f);
        p = p.mul(r).add(8.3334519073e-3f);
        p = p.mul(r).add(4.1665795894e-2f);
        p = p.mul(r).add(1.6666665459e-1f);
        p = p.mul(r).add(5.0000001201e-1f);
        p = p.mul(r).mul(r).add(r).add(1f);
        return p.reinterpretAsInts().add((IntVector) t.reinterpretAsInts().lanewise(VectorOperators.LSHL, 23)).reinterpretAsFloats();
    }

    /** Eight places' logits of m rows less their largest become exponentials; total gets their sums and best the largest. */
    static void exponential(float[] z, int q, int m, float[] total, float[] best) {
        FloatVector top = FloatVector.fromArray(S, z, q);
        for (int c = 1; c < m; c++) { top = top.max(FloatVector.fromArray(S, z, c * BLOCK + q)); }
        FloatVector sum = FloatVector.zero(S);
        for (int c = 0; c < m; c++) {
            FloatVector e = power(FloatVector.fromArray(S, z, c * BLOCK + q).sub(top).max(LEAST));
            e.intoArray(z, c * BLOCK + q);
            sum = sum.add(e);
        }
        sum.intoArray(total, q);
        top.intoArray(best, q);
    }

    /** Rows' values by the factor of each of the block's places; each row's eight sums get theirs. */
    static void scale(float[] z, int m, float[] by, float[] sums) {
        FloatVector f0 = FloatVector.fromArray(S, by, 0), f1 = FloatVector.fromArray(S, by, 8), f2 = FloatVector.fromArray(S, by, 16), f3 = FloatVector.fromArray(S, by, 24);
        for (int c = 0; c < m; c++) {
            FloatVector a = FloatVector.fromArray(S, z, c * BLOCK).mul(f0), b = FloatVector.fromArray(S, z, c * BLOCK + 8).mul(f1);
            FloatVector p = FloatVector.fromArray(S, z, c * BLOCK + 16).mul(f2), q = FloatVector.fromArray(S, z, c * BLOCK + 24).mul(f3);
            a.intoArray(z, c * BLOCK);
            b.intoArray(z, c * BLOCK + 8);
            p.intoArray(z, c * BLOCK + 16);
            q.intoArray(z, c * BLOCK + 24);
            FloatVector.fromArray(S, sums, c * 8).add(a.add(b).add(p.add(q))).intoArray(sums, c * 8);
        }
    }

    /** Shares of attention of eight places from i on, each of those up to itself, given their products. */
    static void shares(float[] a, int from, int i) {
        FloatVector sum = FloatVector.zero(S);
        for (int j = 0; j < i + 8; j++) {
            FloatVector e = power(FloatVector.fromArray(S, a, from + j * W + i).mul(SCALE).min(MOST).max(-MOST));
            e = e.mul(FloatVector.fromArray(S, LATER, 8 - Math.max(0, j - i)));
            e.intoArray(a, from + j * W + i);
            sum = sum.add(e);
        }
        FloatVector part = FloatVector.broadcast(S, 1f).div(sum);
        for (int j = 0; j < i + 8; j++) { FloatVector.fromArray(S, a, from + j * W + i).mul(part).intoArray(a, from + j * W + i); }
    }

    /** Gradient of those places' products, given that of their shares. */
    static void behind(float[] a, int from, float[] g, int i) {
        FloatVector sum = FloatVector.zero(S);
        for (int j = 0; j < i + 8; j++) { sum = FloatVector.fromArray(S, a, from + j * W + i).fma(FloatVector.fromArray(S, g, j * W + i), sum); }
        for (int j = 0; j < i + 8; j++) { FloatVector.fromArray(S, g, j * W + i).sub(sum).mul(FloatVector.fromArray(S, a, from + j * W + i)).mul(SCALE).intoArray(g, j * W + i); }
    }

    static void add(float[] y, int to, float[] x, int from, int n) {
        for (int c = 0; c < n; c += 8) { FloatVector.fromArray(S, y, to + c).add(FloatVector.fromArray(S, x, from + c)).intoArray(y, to + c); }
    }

    static void learn(float[] value, float[] squares, int to, float[] g, int from, int n) {
        int i = 0;
        for (; i + 8 <= n; i += 8) {
            FloatVector v = FloatVector.fromArray(S, g, from + i);
            FloatVector t = v.fma(v, FloatVector.fromArray(S, squares, to + i));
            t.intoArray(squares, to + i);
            FloatVector.fromArray(S, value, to + i).sub(v.mul(RATE).div(t.sqrt())).intoArray(value, to + i);
        }
        for (; i < n; i++) {
            float v = g[from + i], t = squares[to + i] + v * v;
            squares[to + i] = t;
            value[to + i] -= RATE * v / (float) Math.sqrt(t);
        }
    }

    /** States of window w of a batch, which has n places from f on; those up to a whole eight are empty. */
    private void attend(int w, int n, int[] rows, int f) {
        int n8 = wide(n), p = w * W;
        for (int i = 0; i < n; i++) {
            System.arraycopy(flat, emb + rows[f + i] * D, x, (p + i) * D, D);
        }
        add(x, p * D, flat, pos, n * D);
        Arrays.fill(x, (p + n) * D, (p + n8) * D, 0f);
        Arrays.fill(a3, p * Q, (p + n8) * Q, 0f);
        Arrays.fill(att, p * W, (p + n8) * W, 0f);
        Arrays.fill(mid, p * D, (p + n8) * D, 0f);
        for (int i = 0; i < n8; i += 4) { product(D, Q, x, (p + i) * D, D, flat, qkv, Q, a3, (p + i) * Q, Q); }
        for (int i = 0; i < n8; i++) {
            for (int k = 0; k < D; k++) { turned[k * W + i] = a3[(p + i) * Q + k]; }
        }
        for (int j = 0; j < n8; j += 4) {
            int since = j / 8 * 8;
            product(D, n8 - since, a3, (p + j) * Q + D, Q, turned, since, W, att, (p + j) * W + since, W);
        }
        for (int i = 0; i < n8; i += 8) { shares(att, p * W, i); }
        System.arraycopy(x, p * D, h, p * D, n8 * D);
        for (int i = 0; i < n8; i += 4) {
            for (int q = 0; q < D; q += 16) { outer(i / 8 * 8 + 8, att, p * W + i, W, a3, p * Q + 2 * D + q, Q, mid, (p + i) * D + q, D); }
            product(D, D, mid, (p + i) * D, D, flat, o, D, h, (p + i) * D, D);
        }
    }

    /** One head of m rows over n places: with g, gradients of its rows go there and those of the states to dh; without, log chances to log. */
    private void head(float[] rows, int ro, int m, int[] places, int from, int n, boolean outerOne, int first, float part, float[] g) {
        if (g != null) { Arrays.fill(bias, 0, m * 8, 0f); }
        for (int b = 0; b < n; b += BLOCK) {
            int have = Math.min(BLOCK, n - b), wide = (have + 7) / 8 * 8;
            for (int i = 0; i < have; i++) {
                int p = places[from + b + i];
                target[i] = (outerOne ? band[own[p]] : own[p] - first) * BLOCK + i;
                System.arraycopy(h, p * D, hb, i * D, D);
                for (int k = 0; k < D; k++) { hT[k * BLOCK + i] = h[p * D + k]; }
            }
            Arrays.fill(z, 0, (m + 3) / 4 * 4 * BLOCK, 0f);
            for (int c = 0; c < m; c += 4) {
                product(ROW, wide, rows, ro + c * ROW, ROW, hT, 0, BLOCK, z, c * BLOCK, BLOCK);
            }
            for (int i = 0; i < have; i++) { dT[i] = z[target[i]]; }
            for (int q = 0; q < wide; q += 8) { exponential(z, q, m, total, best); }
            if (g == null) {
                for (int i = 0; i < have; i++) { log[places[from + b + i]] += dT[i] - best[i] - (float) Math.log(total[i]); }
                continue;
            }
            for (int i = 0; i < BLOCK; i++) { total[i] = i < have ? part / total[i] : 0f; }
            scale(z, m, total, bias);
            for (int i = 0; i < have; i++) {
                z[target[i]] -= part;
                bias[target[i] / BLOCK * 8] -= part;
            }
            Arrays.fill(z, m * BLOCK, (m + 3) / 4 * 4 * BLOCK, 0f);
            Arrays.fill(dT, 0f);
            for (int k = 0; k < D; k += 4) {
                for (int q = 0; q < wide; q += 16) { outer(m, rows, ro + k, ROW, z, q, BLOCK, dT, k * BLOCK + q, BLOCK); }
            }
            for (int i = 0; i < have; i++) {
                int p = places[from + b + i] * D;
                for (int k = 0; k < D; k++) { dh[p + k] += dT[k * BLOCK + i]; }
            }
            for (int c = 0; c < m; c += 4) {
                for (int q = 0; q < D; q += 16) { product2(have, z, c * BLOCK, BLOCK, hb, q, D, g, c * ROW + q, ROW); }
            }
        }
        if (g != null) {
            for (int c = 0; c < m; c++) {
                float t = 0f;
                for (int i = 0; i < 8; i++) { t += bias[c * 8 + i]; }
                g[c * ROW + D] = t;
            }
        }
    }

    private void firstHead() {
        for (int c = 0; c < bands; c++) {
            for (int j = 0; j < ROW; j++) { outT[c * ROW + j] = flat[out + j * bands + c]; }
        }
    }

    /** The n places by band, those of one in their order; those of band b end at count[b]. */
    private void byBand(int n) {
        Arrays.fill(count, 0);
        for (int i = 0; i < n; i++) { count[band[own[place[i]]] + 1]++; }
        for (int b = 0; b < bands; b++) { count[b + 1] += count[b]; }
        for (int i = 0; i < n; i++) { sorted[count[band[own[place[i]]]]++] = place[i]; }
    }

    /** From the gradient of window w's states, that of the attention's parameters, and of the embedding's rows to dh. */
    private void backward(int w, int n8) {
        int p = w * W;
        for (int c = 0; c < D; c += 4) {
            for (int q = 0; q < D; q += 16) { outer(n8, mid, p * D + c, D, dh, p * D + q, D, go, c * D + q, D); }
        }
        Arrays.fill(ds, 0f);
        Arrays.fill(dmid, 0f);
        Arrays.fill(d, 0f);
        for (int i = 0; i < n8; i += 4) { product(D, D, dh, (p + i) * D, D, oT, 0, D, dmid, i * D, D); }
        for (int i = 0; i < n8; i++) {
            for (int c = 0; c < D; c++) { turned[c * W + i] = dmid[i * D + c]; }
        }
        for (int j = 0; j < n8; j += 4) {
            int since = j / 8 * 8;
            product(D, n8 - since, a3, (p + j) * Q + 2 * D, Q, turned, since, W, ds, j * W + since, W);
        }
        for (int i = 0; i < n8; i += 8) { behind(att, p * W, ds, i); }
        for (int i = 0; i < n8; i += 4) {
            for (int q = 0; q < D; q += 16) { outer(i / 8 * 8 + 8, ds, i, W, a3, p * Q + D + q, Q, d, i * Q + q, Q); }
            int since = i / 8 * 8;
            product(n8 - since, D, ds, i * W + since, W, a3, (p + since) * Q, Q, d, i * Q + D, Q);
            product(n8 - since, D, att, (p + i) * W + since, W, dmid, since * D, D, d, i * Q + 2 * D, Q);
        }
        for (int c = 0; c < D; c += 4) {
            for (int q = 0; q < Q; q += 16) { outer(n8, x, p * D + c, D, d, q, Q, gqkv, c * Q + q, Q); }
        }
        for (int i = 0; i < n8; i += 4) { product(Q, D, d, i * Q, Q, qkvT, 0, D, dh, (p + i) * D, D); }
        add(gpos, 0, dh, p * D, n8 * D);
    }

    /** rows seen and ranks of texts one after another, and where each begins. */
    private int[] rows, ranks, begin;

    private void texts(byte[][] texts) {
        begin = new int[texts.length + 1];
        for (int i = 0; i < texts.length; i++) { begin[i + 1] = Math.addExact(begin[i], texts[i].length / item); }
        int n = begin[texts.length];
        rows = new int[n];
        ranks = new int[n];
        for (int i = 0, j = 0; i < texts.length; i++) {
            byte[] t = texts[i];
            for (int k = 0; k + item <= t.length; k += item, j++) {
                int id = (t[k] & 255) | (t[k + 1] & 255) << 8;
                if (item == 4) { id |= (t[k + 2] & 255) << 16 | (t[k + 3] & 255) << 24; }
                ranks[j] = rank[id];
                rows[j] = k == 0 ? 0 : ranks[j - 1] + 1;
            }
        }
    }

    private Object train(byte[][] all, long seed) {
        read(true);
        texts(all);
        int windows = 0;
        for (int i = 0; i < all.length; i++) { windows += (begin[i + 1] - begin[i] + W - 1) / W; }
        int[] from = new int[windows], length = new int[windows];
        for (int i = 0, j = 0; i < all.length; i++) {
            for (int f = begin[i]; f < begin[i + 1]; f += W, j++) {
                from[j] = f;
                length[j] = Math.min(W, begin[i + 1] - f);
            }
        }
        long[] order = new long[windows];
        for (int i = 0; i < windows; i++) {
            long v = i + (seed + 1) * 0x9E3779B97F4A7C15L;
            v ^= v >>> 30;
            v *= 0xBF58476D1CE4E5B9L;
            v ^= v >>> 27;
            v *= 0x94D049BB133111EBL;
            v ^= v >>> 31;
            order[i] = v >>> 32 << 31 | i;
        }
        Arrays.sort(order);
        for (int s = 0; s < windows; s += batch) { step(order, from, length, s, Math.min(batch, windows - s)); }
        int parts = (params * 4 + chunk - 1) / chunk;
        Object[] sentBack = new Object[parts];
        for (int i = 0; i < parts; i++) {
            ByteBuffer b = ByteBuffer.allocate(Math.min(chunk, params * 4 - i * chunk)).order(ByteOrder.LITTLE_ENDIAN);
            b.asFloatBuffer().put(flat, i * chunk / 4, b.capacity() / 4);
            sentBack[i] = b.array();
        }
        return sentBack;
    }

    private void step(long[] order, int[] from, int[] length, int s, int some) {
        int n = 0;
        for (int w = 0; w < some; w++) {
            int k = (int) (order[s + w] & 0x7FFFFFFFL);
            attend(w, length[k], rows, from[k]);
            for (int i = 0; i < length[k]; i++) {
                own[w * W + i] = ranks[from[k] + i];
                place[n++] = w * W + i;
            }
        }
        float part = 1f / Math.max(1, n);
        Arrays.fill(dh, 0, some * W * D, 0f);
        Arrays.fill(gout, 0f);
        firstHead();
        head(outT, 0, bands, place, 0, n, true, 0, part, gout);
        byBand(n);
        for (int b = 0, i = 0; b < bands; i = count[b], b++) {
            int m = hi[b] - lo[b];
            if (m < 2 || count[b] == i) { continue; }
            Arrays.fill(ginner, 0, m * ROW, 0f);
            head(flat, inner + lo[b] * ROW, m, sorted, i, count[b] - i, false, lo[b], part, ginner);
            learn(flat, sq, inner + lo[b] * ROW, ginner, 0, m * ROW);
        }
        for (int i = 0; i < D; i++) {
            for (int j = 0; j < D; j++) { oT[j * D + i] = flat[o + i * D + j]; }
            for (int j = 0; j < Q; j++) { qkvT[j * D + i] = flat[qkv + i * Q + j]; }
        }
        Arrays.fill(go, 0f);
        Arrays.fill(gqkv, 0f);
        Arrays.fill(gpos, 0f);
        int some2 = 0;
        for (int w = 0; w < some; w++) {
            int k = (int) (order[s + w] & 0x7FFFFFFFL);
            backward(w, wide(length[k]));
            for (int i = 0; i < length[k]; i++) {
                int row = rows[from[k] + i];
                if (slot[row] < 0) {
                    slot[row] = some2;
                    held[some2] = row;
                    System.arraycopy(dh, (w * W + i) * D, gemb, some2++ * D, D);
                } else {
                    add(gemb, slot[row] * D, dh, (w * W + i) * D, D);
                }
            }
        }
        for (int i = 0; i < some2; i++) {
            learn(flat, sq, emb + held[i] * D, gemb, i * D, D);
            slot[held[i]] = -1;
        }
        for (int c = 0; c < bands; c++) {
            for (int j = 0; j < ROW; j++) { outT[j * bands + c] = gout[c * ROW + j]; }
        }
        learn(flat, sq, out, outT, 0, ROW * bands);
        learn(flat, sq, o, go, 0, D * D);
        learn(flat, sq, qkv, gqkv, 0, D * Q);
        learn(flat, sq, pos, gpos, 0, W * D);
    }

    private double score(byte[] text) {
        if (flat == null) {
            read(false);
            firstHead();
        }
        texts(new byte[][] {text});
        int n = 0, used = 0;
        double sum = 0;
        for (int f = 0; f == 0 || f + OVERLAP < ranks.length; f += W - OVERLAP) {
            int len = Math.min(W, ranks.length - f);
            attend(used, len, rows, f);
            for (int i = f == 0 ? 0 : OVERLAP; i < len; i++) {
                own[used * W + i] = ranks[f + i];
                log[used * W + i] = 0f;
                place[n++] = used * W + i;
            }
            if (++used == batch || f + W >= ranks.length) {
                head(outT, 0, bands, place, 0, n, true, 0, 0f, null);
                byBand(n);
                for (int b = 0, i = 0; b < bands; i = count[b], b++) {
                    if (hi[b] - lo[b] > 1 && count[b] > i) { head(flat, inner + lo[b] * ROW, hi[b] - lo[b], sorted, i, count[b] - i, false, lo[b], 0f, null); }
                }
                for (int i = 0; i < n; i++) { sum += log[place[i]]; }
                n = 0;
                used = 0;
            }
        }
        return sum;
    }

    /** Of a text's ids the sum of their log chances; of an array of texts the parameters after training, in pieces; of null the floats of a vector here. */
    public Object call(Object ids, Object seed) throws Exception {
        if (ids == null) { return Double.valueOf(FloatVector.SPECIES_PREFERRED.length()); }
        if (ids instanceof byte[]) { return Double.valueOf(((byte[]) ids).length == 0 ? 0.0 : score((byte[]) ids)); }
        scala.collection.Seq all = (scala.collection.Seq) ids;
        byte[][] own = new byte[all.size()][];
        for (int i = 0; i < own.length; i++) { own[i] = (byte[]) all.apply(i); }
        return train(own, ((Long) seed).longValue());
    }
}
"""

NAME, LANES = "SluiceLanguageModel", 8
_classes: dict[str, object] = {}
_ready: dict[str, bool] = {}


def _session(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId}:{spark._jsparkSession.sessionUUID()}"


def _compile(spark: SparkSession, constants: dict[str, object]) -> object:
    """The class, compiled with these constants; its jar goes to the executors."""
    source = SOURCE
    for k, v in constants.items():
        source = source.replace(f"@{k}@", str(v))
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(source)
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-"), f"languagemodel-{uuid.uuid4().hex}.jar")
    with zipfile.ZipFile(path, "w") as jar:
        for name, code in dict(compiler.getBytecodes()).items():
            jar.writestr(name.replace(".", "/") + ".class", bytes(code))
    spark.sql(f"ADD JAR '{path}'")
    return compiler.getClassLoader().loadClass(NAME)


def function(spark: SparkSession, packed: bytes, batch: int, chunk: int, kind: str) -> str:
    """Name of a function of (ids or texts, seed) by a model as :func:`pack` gives it, with results of this kind."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    kinds, args = gateway.new_array(jvm.Class, 3), gateway.new_array(jvm.Object, 3)
    kinds[0], kinds[1], kinds[2] = jvm.Class.forName("org.apache.spark.broadcast.Broadcast"), jvm.Integer.TYPE, jvm.Integer.TYPE
    args[0], args[1], args[2] = spark._jsc.broadcast(packed), batch, chunk
    made = _classes[_session(spark)].getDeclaredConstructor(kinds).newInstance(args)
    name = f"sluice_lm_{uuid.uuid4().hex}"
    spark._jsparkSession.udf().register(name, made, jvm.org.apache.spark.sql.types.DataType.fromDDL(kind))
    return name


def ready(spark: SparkSession, constants: dict[str, object]) -> bool:
    """Can this session's executors run it, with vectors of eight floats? Asked once, of an executor."""
    session = _session(spark)
    if session not in _ready:
        try:
            _classes[session] = _compile(spark, constants)
            name = function(spark, b"", 1, 1, "double")
            _ready[session] = spark.range(1).selectExpr(f"{name}(null, 0L) as n").first().n >= LANES
        except Exception as e:  # noqa: BLE001 - py4j and Spark name many kinds
            logging.getLogger(__name__).warning("language-model scoring goes by numpy: %s", str(e)[:500])
            _ready[session] = False
    return _ready[session]


def pack(flat: np.ndarray, voc, itemsize: int) -> bytes:
    """Parameters and vocabulary as the class reads them."""
    head = np.array([itemsize, len(voc.rank), voc.size, len(voc.lo), len(flat)], "<i4")
    return b"".join(x.astype(t).tobytes() for x, t in ((head, "<i4"), (voc.rank, "<i4"), (voc.lo, "<i4"), (voc.hi, "<i4"), (flat, "<f4")))
