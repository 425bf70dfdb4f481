"""Model plans, layer by layer (every function is a lazy DataFrame transform).

staging   T1-T9: bronze strings -> typed, renamed, deduplicated tables
core      M1-M9: four dimensions, four facts, one intermediate
gold      G1-G8: business marts, the hub what-if and routing
scenario  V1-V7: analytics over the what-if table and the route sample
quality   Q1-Q5: declared checks, the optimizer invariant, the gate
build     the model DAG (lazy `Models`) and the layered, written build
registry  named queries over the driver test tables
"""
