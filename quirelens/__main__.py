import sys

from quirelens.cli import main

sys.exit(main())
