"""What the pipeline's stages give back of the driver's memory."""

import gc
import time
from pathlib import Path

import pytest

import corpus_pipeline
from shroud.llm import common, components


def resident(pid):
    return int(Path(f"/proc/{pid}/statm").read_text().split()[1]) * 4096 / 1e6


def test_release_gives_native_memory_of_the_jvm_back(spark):
    """Buffers too small to be mapped alone are freed to the C library, which keeps them between those that are still held."""
    jvm = spark.sparkContext._jvm
    if "systemTrimNativeHeap" not in [str(x) for x in commands(jvm)]:
        pytest.skip("this JVM has no such command")
    pid = jvm.java.lang.ProcessHandle.current().pid()
    made = [jvm.java.nio.ByteBuffer.allocateDirect(100_000) for _ in range(2000)]
    before, kept = resident(pid), made[::10]
    del made
    for _ in range(3):  # buffers are freed by a thread of the JVM's own, after its collection
        gc.collect()
        common.release(spark)
        time.sleep(0.5)
    assert len(kept) == 200 and resident(pid) < before - 100


def commands(jvm):
    name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    kinds = array(jvm, jvm.java.lang.Class, jvm.java.lang.Class.forName("javax.management.ObjectName"))
    info = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("getMBeanInfo", kinds)
    return [x.getName() for x in info.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), array(jvm, jvm.java.lang.Object, name)).getOperations()]


def array(jvm, kind, *items):
    from pyspark import SparkContext

    made = SparkContext._gateway.new_array(kind, len(items))
    for k, x in enumerate(items):
        made[k] = x
    return made


def test_rounds_of_components_let_go_of_the_drivers_memory(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(components, "release", calls.append)
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert {(r.node, r.component) for r in components.connected_components(edges).collect()} == {(k, 0) for k in range(41)}
    assert len(calls) >= 3


def test_stages_begin_by_giving_memory_back(spark, monkeypatch):
    class Given(Exception):
        pass

    def give(session):
        raise Given

    monkeypatch.setattr(corpus_pipeline, "release", give)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Given):
            stage(spark, None, "")
