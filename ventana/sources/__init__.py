"""Sources and sinks: file formats, the dataset catalog and the bindings
of the driver tables to the demand-matrix shape."""
