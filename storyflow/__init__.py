"""storyflow: PySpark-native processing of long-video annotation data.

Layout: ``functions`` holds Column helpers, ``operators`` DataFrame to DataFrame
transforms, ``sources`` readers and writers, ``streaming`` Structured Streaming
jobs, ``plans`` the registered queries with their oracle SQL. The optional
subpackage ``llm`` holds the text operators for training data; nothing outside
it imports it.
"""

__version__ = "0.1.0"
