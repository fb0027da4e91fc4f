"""Operators for large text corpora (training-data pipelines). Nothing outside this
package imports it."""
