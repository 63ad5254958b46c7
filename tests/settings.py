"""Tables and small model settings of the tests."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

# Small settings for tests only (same code path, fewer trees and iterations).
GBT_QUICK = {"maxIter": 5, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "auto"}
GBT_QUICK_GRID = {"maxIter": [2, 3], "maxDepth": [3, 4], "subsamplingRate": [0.7, 0.8]}
MLP_QUICK = {"hidden": [16], "maxIter": 30, "blockSize": 128}
MLP_QUICK_GRID = {"maxIter": [10, 15, 20], "blockSize": [64, 128]}
