"""No streaming operators.

The reference processes static tables only (no streams, watermarks, windows
or state), so nothing here is needed to match it; every operator in this
package works on batch DataFrames.
"""
