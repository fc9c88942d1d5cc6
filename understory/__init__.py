"""Understory: Spark-native analytics for point clouds and tree inventories."""
