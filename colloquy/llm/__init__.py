"""Training-data operators (see the README's table) and their queries.

Nothing else in the package imports this folder.  Executors must be able to
import the package (``--py-files`` or an installed wheel): the Python workers
keep compiled tables per process, which needs import by name.
"""
