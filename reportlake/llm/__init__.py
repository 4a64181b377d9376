"""Training-data operators: decontamination, fingerprints, URL filters, language ID, packing,
near-duplicates, repeated passages, language-model scoring and secret scans.

Nothing else in the library imports this subpackage. Workers import it too, so on a cluster the
package must be on the executors' Python path (``--py-files``).
"""
