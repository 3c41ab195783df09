"""Long steps give the driver's garbage back between their jobs."""

from quirelens.llm import components


def test_driver_garbage_goes_between_rounds(spark):
    def whole() -> int:
        """Collections of the whole heap so far; without a call, Spark has one in half an hour."""
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before = whole()
    found = components.components(spark.createDataFrame([(1, 2)], "a long, b long"))
    assert whole() > before
    assert {tuple(r) for r in found.collect()} == {(1, 1), (2, 1)}
