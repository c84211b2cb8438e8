"""The model DAG and the queries built on it.

staging / intermediate / marts  the models; project.Project wires them lazily
quality                         the 30 key tests
metrics                         dashboard queries over the marts
targets                         quota and customer derivations
pipeline                        a full build: marts written, tests run on them
"""
